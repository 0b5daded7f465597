"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Training counts the hashed 1- to 3-grams of every labelled text per language
inside Spark tasks (numpy), sums them in Spark, and makes one matrix of
log-probabilities (buckets x languages).  The matrix is broadcast, its size
fixed by ``buckets`` and checked against ``MODEL_BYTES``; scoring adds the rows
of a text's n-grams.  Texts are used whole, long ones in overlapping pieces.

Defined cases: a null text or one without a letter is ``und`` with score 0;
with no language learned every text is ``und``; a null lang trains nothing;
equal scores take the language first in code-point order; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.llm.common import arrow_map, id_remainder, read_table, slices
from closeledger.llm.words import mix

BUCKETS = 1 << 15
ORDERS = 3
MODEL_BYTES = 64 << 20
PIECE = 1 << 20


def gram_buckets(text: str, buckets: int, orders: int = ORDERS) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the lower-cased text, piece by piece;
    each n-gram belongs to the piece in which it starts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for start in range(0, len(points), PIECE):
        part = points[start : start + PIECE + orders - 1]
        out, h = [], np.zeros(len(part), np.uint64)
        for order in range(1, orders + 1):
            if len(part) < order:
                break
            h = h[: len(part) - order + 1] * np.uint64(0x100000001B3) + part[order - 1 :] + np.uint64(order)
            own = h[: min(PIECE, len(h))]
            out.append((mix(own) & np.uint64(buckets - 1)).astype(np.int64))
        yield np.concatenate(out)


@dataclass
class NaiveBayes:
    languages: list[str]
    log_prior: np.ndarray  # (languages,)
    log_prob: np.ndarray  # (buckets, languages)

    def score(self, text: str) -> tuple[str, float]:
        """Language and its posterior probability."""
        if not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0
        total = self.log_prior.copy()
        for rows in gram_buckets(text, len(self.log_prob)):
            total += self.log_prob.take(rows, axis=0).sum(axis=0)
        best = int(np.argmax(total))
        return self.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, label: str = "lang", buckets: int = BUCKETS, smoothing: float = 0.5) -> NaiveBayes:
    """Count n-grams of every row of ``docs`` with a label."""
    rows = docs.select(F.col(label).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null")
    totals = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MODEL_BYTES // (8 * buckets) + 1)
    languages = {r["lang"]: r["n"] for r in totals.collect()}
    if len(languages) * buckets * 8 > MODEL_BYTES:
        raise ValueError(f"over {MODEL_BYTES} bytes of model: too many languages for {buckets} buckets")
    names = sorted(languages)
    numbers = {name: i for i, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(names), buckets), np.int64)
        for batch in slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for found in gram_buckets(text, buckets):
                    table[numbers[lang]] += np.bincount(found, minlength=buckets)
        lang, bucket = np.nonzero(table)
        values = [lang.astype(np.int32), bucket.astype(np.int32), table[lang, bucket]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["l", "b", "n"])

    counts = np.zeros((buckets, len(names)))
    if names:
        sums = arrow_map(rows, count, "l int, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n"))
        cells = sums.toArrow()
        counts[cells["b"].to_numpy(), cells["l"].to_numpy()] = cells["n"].to_numpy()
    counts += smoothing
    priors = np.array([languages[n] for n in names], dtype=float)
    return NaiveBayes(names, np.log(priors / priors.sum()) if names else priors, np.log(counts / counts.sum(axis=0)) if names else counts)


def predict(docs: DataFrame, model: NaiveBayes, *keep: Column) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nb = shared.value
        for batch in slices(batches, "text"):
            found = [nb.score(t or "") for t in batch.column("text").to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), "lang_pred", "score"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return arrow_map(rows, score, ", ".join([*types, "lang_pred string", "score double"]))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from documents whose crc32(doc_id) mod 4 is not 2; predict all."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = train(docs.where(~held_out))
    return predict(docs, model, F.col("doc_id"), held_out.alias("held_out"))
