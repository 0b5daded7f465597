"""Small helpers shared by the operators: scratch tables on the cluster's
shared folder, a distributed row rank, and text access in Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from closeledger.session import ensure_checkpoint_dir
from closeledger.session import ship_package as ship

#: Bytes of text that one numpy block of a task works on.
BLOCK_BYTES = 8 << 20

#: Spark's own settings while a table is stored: remove a query's shuffle files at
#: its end, and keep the batches that go to Python small (by default 64 MB each).
STORING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BLOCK_BYTES),
}


def release() -> None:
    """Give memory that a task no longer uses back to the system, as Python
    workers live on and share an executor's memory with its JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own rules
        pass


def arrow_map(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:  # noqa: ANN001
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        release()

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: the lineage is cut, and a lost executor loses nothing.  Shuffle
    files of the write go when it is done, as no later step reads them."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/closeledger-llm/{uuid.uuid4().hex}/{label}"
    before = {k: spark.conf.get(k, None) for k in STORING}
    for k, v in STORING.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        release()
    return spark.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, label: str, **totals: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates of the rows, taken while they are written."""
    seen = Observation()
    out = stored(df.observe(seen, *[c.alias(name) for name, c in totals.items()]), label)
    return out, seen.get


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (a null id counts
    as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def ranked(df: DataFrame, order: list[str], rank: str, label: str) -> tuple[DataFrame, int]:
    """Global row rank (from 0) in ``order`` and the number of rows.

    Rows are range-partitioned and sorted in Spark, and the positions are
    stored; only one count per partition reaches the driver.  ``order`` should
    end in columns that tell rows apart, so that no key value fills a task.
    """
    spark = df.sparkSession
    placed = (
        df.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_cl_part", F.spark_partition_id())
        .withColumn("_cl_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    placed = stored(placed, label)
    sizes = sorted((r["_cl_part"], r["n"]) for r in placed.groupBy("_cl_part").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts or [(0, 0)], "_cl_part int, _cl_start long")
    out = placed.join(F.broadcast(offsets), "_cl_part").withColumn(rank, F.col("_cl_start") + F.col("_cl_pos"))
    return out.drop("_cl_part", "_cl_pos", "_cl_start"), total


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text of a slice stays near ``limit``
    bytes (a longer text stays whole, alone)."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
