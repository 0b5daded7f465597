"""Sharding along a Hilbert curve over document metadata.

Every row gets a cell on a grid of several metadata dimensions (text size,
language, source, id), the rows are sorted by the cell's place on the Hilbert
curve, and the order is cut into runs whose row counts differ by at most one.
A shard then covers a compact region of all dimensions at once, and
``manifest`` gives the cell range of each shard and dimension, by which a
reader skips shards.

Defined cases: a null text has size 8 and the checksum of the empty text;
null metadata takes cell 0; rows equal in every column get places of their
own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from closeledger.llm.common import partitions, ranked, read_table, ship, stored
from closeledger.llm.hilbert import hilbert_index

#: Bits of each dimension; four dimensions make a 24-bit curve.
BITS = 6
NUMBERS, NAMES = ("size", "doc_id"), ("lang", "source")


def name_cell(column: Column, bits: int = BITS) -> Column:
    """Cell of a name: 0 for null, else 1 + a hash below 2**bits - 1."""
    return F.coalesce((F.crc32(column.cast("string").cast("binary")) % (2**bits - 1) + 1).cast("int"), F.lit(0))


def number_cell(value: float | None, edges: list[float]) -> int:
    """Cell of a number among quantile edges: 0 for null."""
    return 0 if value is None else 1 + bisect.bisect_left(edges, value)


def shards(docs: DataFrame, count: int = 24, bits: int = BITS, row: str | None = None) -> tuple[DataFrame, dict[str, list[float]]]:
    """(rows with their shard and cells, quantile edges of the number dimensions).

    Columns: doc_id, size, text_crc32, lang, source, cell_* per dimension,
    curve, shard, slot; and the column ``row``, if named, that tells rows apart."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.monotonically_increasing_id().alias("_cl_row") if row is None else F.col(row).alias("_cl_row"),
    )
    rows = stored(rows, "metadata")
    marks = [i / (2**bits - 1) for i in range(1, 2**bits - 1)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), marks, 10000).alias(c) for c in NUMBERS]).first()
    edges = {c: sorted(set(found[c] or [])) for c in NUMBERS}

    def curve(size: pd.Series, doc_id: pd.Series, lang: pd.Series, source: pd.Series) -> pd.Series:
        cells = np.stack([size, doc_id, lang, source], axis=1)
        return pd.Series(hilbert_index(cells, bits))

    def cells_of(column: str):  # noqa: ANN202
        cuts = np.array(edges[column])

        def cell(values: pd.Series) -> pd.Series:
            got = values.to_numpy("float64", na_value=np.nan)
            return pd.Series(np.where(np.isnan(got), 0, 1 + np.searchsorted(cuts, got)).astype("int32"))

        return F.pandas_udf(cell, "int")(F.col(column).cast("double"))

    for c in NUMBERS:
        rows = rows.withColumn(f"cell_{c}", cells_of(c))
    for c in NAMES:
        rows = rows.withColumn(f"cell_{c}", name_cell(F.col(c), bits))
    rows = rows.withColumn("curve", F.pandas_udf(curve, LongType())(*[F.col(f"cell_{c}") for c in (*NUMBERS, *NAMES)]))
    rows, total = ranked(rows, ["curve", "doc_id", "_cl_row"], "_cl_rank", "curve")
    shard = F.expr(f"cast((_cl_rank * {count}) div {max(total, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {total} + {count - 1}) div {count}")
    rows = rows.withColumn("shard", shard).withColumn("slot", F.col("_cl_rank") - first)
    return rows.drop("_cl_rank" if row else "_cl_row", "_cl_rank").withColumnRenamed("_cl_row", row or "_cl_row"), edges


def manifest(sharded: DataFrame) -> DataFrame:
    """One row per shard: rows, bytes, and the cell range of each dimension."""
    ranges = [f(f"cell_{c}").alias(f"{how}_{c}") for c in (*NUMBERS, *NAMES) for how, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), *ranges)


def write_shards(docs: DataFrame, path: str, count: int = 24, folder: str = "shard") -> DataFrame:
    """Write the documents, one folder (``folder``=0, 1, ...) per shard, and
    return the rows of ``shards``.  Every row goes to its own shard, copies too,
    as the documents are stored with their row numbers first.  A column with the
    folder's name would be lost in the folders' names and is refused."""
    if folder in docs.columns:
        raise ValueError(f"the documents have a column {folder!r}; name the folders otherwise")
    rows = stored(docs.withColumn("_cl_row", F.monotonically_increasing_id()), "documents")
    placed, _ = shards(rows, count, row="_cl_row")
    placed = stored(placed, "places")
    joined = rows.join(placed.select(F.col("_cl_row"), F.col("shard").alias("_cl_shard")), "_cl_row").drop("_cl_row")
    joined = joined.withColumnRenamed("_cl_shard", folder)
    # a few writing tasks per shard
    spread = F.pmod(F.xxhash64("doc_id", F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit("")))), F.lit(4))
    joined.repartition(partitions(docs.sparkSession), F.col(folder), spread).write.mode("overwrite").partitionBy(folder).parquet(path)
    return placed.drop("_cl_row")


def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the ``rows`` law."""
    rows, _ = shards(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
