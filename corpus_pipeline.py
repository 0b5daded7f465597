"""Corpus pipeline over ``documents``: every stage takes what the stage before
it kept, as a written table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from closeledger.llm.common import read_table, stored
from closeledger.llm.decontam import decontamination_stage
from closeledger.llm.jaccard import near_duplicate_stage
from closeledger.llm.pieces import encoding_stage
from closeledger.llm.rulefit import quality_stage
from closeledger.llm.windows import suffix_stage

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("suffix-array dedup", suffix_stage),
    ("benchmark decontamination", decontamination_stage),
    ("sentencepiece encoding", encoding_stage),
]

#: No SQL expresses the classifier or the encoder; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
