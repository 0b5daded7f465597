"""Control counts and reconciliation.

A control count is an independent recount of an extract's rows at its
grain; reconciliation compares it with the rows actually produced.  Both
stay distributed: a count is a global aggregate (partial counts per task,
one tiny final task), and the comparison unions two one-row frames and
folds them with conditional aggregates instead of joining them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, stamp: Column | None = None, stamp_name: str = "insrt_on") -> DataFrame:
    """One row: ``(stamp, row_cnt)``, or just ``row_cnt`` without a stamp."""
    counted = df.agg(F.count(F.lit(1)).alias("row_cnt"))
    if stamp is None:
        return counted
    return counted.select(stamp.alias(stamp_name), "row_cnt")


def reconcile(extract: DataFrame, control: DataFrame, control_column: str = "row_cnt") -> DataFrame:
    """One row: ``extract_rows``, ``control_rows``, ``matched``."""
    produced = extract.agg(F.count(F.lit(1)).alias("n")).select(F.lit("extract").alias("side"), "n")
    expected = control.agg(F.sum(control_column).cast("bigint").alias("n")).select(F.lit("control").alias("side"), "n")
    both = produced.unionByName(expected)
    folded = both.agg(
        F.max(F.when(F.col("side") == "extract", F.col("n"))).alias("extract_rows"),
        F.max(F.when(F.col("side") == "control", F.col("n"))).alias("control_rows"),
    )
    return folded.withColumn("matched", F.coalesce(F.col("extract_rows") == F.col("control_rows"), F.lit(False)))


def check_reconciled(extract_rows: int, control_rows: int) -> None:
    """Raise when a produced row count differs from its control count."""
    if extract_rows != control_rows:
        raise ValueError(f"extract produced {extract_rows} rows, control count is {control_rows}")
