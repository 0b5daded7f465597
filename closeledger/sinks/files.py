"""File sinks: the quoted-CSV extract contract and Parquet by period.

CSV contract of the extract files: a header line, every field quoted,
``"`` doubled inside fields, NULL written as the empty text ``""``, blanks
kept, line feeds inside fields kept, ``\\n`` between records (``\\r\\n`` on
request).  Spark's CSV defaults differ on escape (``\\``) and on blanks
(trimmed), so the options are set explicitly.

With ``crlf=True`` Spark's writer also turns a line feed *inside* a quoted
field into ``\r\n``; the default ``\n`` keeps field text unchanged.

A CSV extract is a directory of part files written in parallel, one header
per part.  With ``single_file=True`` it holds one file with one header: the
parts are written in parallel without headers, and their bytes are put together
(``copies.one_csv_file``), so no extract passes through one writer task.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closeledger.functions.labels import as_text_view, rename_positional
from closeledger.session import ensure_checkpoint_dir
from closeledger.sinks.copies import one_csv_file

CSV_WRITE_OPTIONS = {
    "header": "true",
    "quoteAll": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def csv_frame(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The frame a CSV extract holds: positional names, all text, NULL as ''."""
    if names is not None:
        df = rename_positional(df, names)
    return as_text_view(df)


def write_csv(
    df: DataFrame,
    path: str,
    names: list[str] | None = None,
    mode: str = "overwrite",
    single_file: bool = False,
    crlf: bool = False,
) -> None:
    out = csv_frame(df, names)
    end = "\r\n" if crlf else "\n"
    w = out.write.mode(mode).options(**CSV_WRITE_OPTIONS).option("lineSep", end)
    if not single_file:
        w.csv(path)
        return
    if mode != "overwrite":
        raise ValueError("a single file replaces the one before it; use mode='overwrite'")
    parts = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/csv-parts-{uuid.uuid4().hex}"
    w.option("header", "false").csv(parts)
    header = ",".join('"' + c.replace('"', '""') + '"' for c in out.columns) + end
    one_csv_file(df.sparkSession, parts, header.encode(), path)


def read_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Read a CSV extract back as text columns (``""`` comes back as NULL;
    ``csv_frame`` turns it into ``''`` again on rewrite)."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    replace_partitions: bool = False,
    mode: str = "append",
    max_records_per_file: int | None = None,
) -> None:
    """Append (default) or replace only the partitions present in ``df``
    (dynamic partition overwrite: re-running one period rewrites that period
    and leaves the others alone)."""
    w = df.write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if replace_partitions:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    w.parquet(path)


@dataclass(frozen=True)
class CsvTarget:
    path: str
    names: tuple[str, ...] | None = None
    single_file: bool = False
    crlf: bool = False

    @property
    def holds_only_this_run(self) -> bool:
        # written in overwrite mode and readable back by name
        return bool(self.names)

    def write(self, df: DataFrame) -> None:
        write_csv(df, self.path, list(self.names) if self.names else None, "overwrite", self.single_file, self.crlf)

    def read(self, spark: SparkSession) -> DataFrame:
        if not self.names:
            raise ValueError("reading a CSV target back needs its column names")
        return read_csv(spark, self.path, list(self.names))


@dataclass(frozen=True)
class ParquetTarget:
    path: str
    partition_by: tuple[str, ...] = ()
    replace_partitions: bool = False
    mode: str = "append"

    @property
    def holds_only_this_run(self) -> bool:
        return self.mode == "overwrite" and not self.replace_partitions

    def write(self, df: DataFrame) -> None:
        write_parquet(df, self.path, list(self.partition_by) or None, self.replace_partitions, self.mode)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


# Columns the extracts filter on, in the order the fact is clustered by.
LEDGER_CLUSTER = ("business_unit", "operating_unit", "account")


def write_ledger_fact(
    df: DataFrame,
    path: str,
    num_partitions: int | None = None,
    replace_periods: bool = True,
    cluster_by: tuple[str, ...] = LEDGER_CLUSTER,
    max_records_per_file: int = 5_000_000,
) -> None:
    """Write the ledger fact in the layout the extracts read best.

    * one directory per ``drill_date``: a period extract reads one partition;
    * rows range-partitioned and sorted by ``(drill_date, *cluster_by)``, so
      each file covers a narrow band of codes and the extracts' code and
      account predicates skip whole files and row groups on Parquet min/max
      statistics;
    * a hash of the whole line is the last range key, so a code combination
      holding a third of the lines is still cut across many tasks and files
      instead of one;
    * ``replace_periods`` rewrites only the periods present in ``df``;
    * files hold at most ``max_records_per_file`` lines (~0.5 GB of ledger
      lines at the default), whatever the task size.

    Size ``num_partitions`` (the writer tasks) from the input, about one per
    GB (100 TB: ~100,000); the default is the session's shuffle partitions.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__spread")
    keys = [F.col("drill_date"), *[F.col(c) for c in cluster_by]]
    laid = df.withColumn("__spread", spread).repartitionByRange(n, *keys, F.col("__spread"))
    laid = laid.sortWithinPartitions(*keys).drop("__spread")
    write_parquet(
        laid, path, ["drill_date"], replace_partitions=replace_periods,
        mode="overwrite" if replace_periods else "append", max_records_per_file=max_records_per_file,
    )
