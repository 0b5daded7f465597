"""Relational landing tables over JDBC.

Rows are appended with batched multi-row inserts from every partition in
parallel (``numPartitions`` caps the concurrent connections the database
sees).  Errors propagate: a failed load fails the run.  Appends are not
idempotent; re-running a period appends again, so callers that need
replace semantics write Parquet with ``replace_partitions``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    mode: str = "append",
    batchsize: int = 1000,
    num_partitions: int | None = None,
) -> None:
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", str(batchsize))
    if num_partitions is not None:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    batchsize: int = 1000
    num_partitions: int | None = None

    def write(self, df: DataFrame) -> None:
        write_jdbc(df, self.url, self.table, self.properties, "append", self.batchsize, self.num_partitions)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").option("url", self.url).option("dbtable", self.table).options(**self.properties).load()
