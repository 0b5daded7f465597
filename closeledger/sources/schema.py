"""Input and output schemas, and readers for the ledger tables.

The ledger fact is expected as Parquet partitioned by ``drill_date`` (one
directory per accounting period), so a one-period extract reads one
partition: the period equality shows up as ``PartitionFilters`` in the scan.
Any other source (a catalog table, a JDBC view, a derived DataFrame) works as
long as it carries these columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S = T.StringType()

LEDGER_FACT = T.StructType(
    [
        T.StructField("account", S, False),
        T.StructField("ledger", S, False),
        T.StructField("drill_date", T.DateType(), False),
        T.StructField("project_id", S, True),
        T.StructField("business_unit", S, True),
        T.StructField("operating_unit", S, True),
        T.StructField("location", S, True),
        T.StructField("deptid", S, True),
        T.StructField("line_descr", S, True),
        T.StructField("descr", S, True),
        T.StructField("descr254", S, True),
        T.StructField("oprid", S, True),
        T.StructField("source", S, True),
        T.StructField("journal_id", S, True),
        T.StructField("posted_date", T.DateType(), True),
        T.StructField("reversal_cd", S, True),
        T.StructField("amount", T.DecimalType(19, 4), True),
    ]
)

LEAVES = T.StructType(
    [
        T.StructField("treecd", S, False),
        T.StructField("node", S, False),
        T.StructField("leaf", S, False),
    ]
)

OPERATORS = T.StructType(
    [
        T.StructField("employeeid", S, False),
        T.StructField("employeename", S, True),
    ]
)

STORED_COUNTS = T.StructType(
    [
        T.StructField("insrt_on", T.DateType(), True),
        T.StructField("row_cnt", T.LongType(), True),
    ]
)

POSTED_DATES = T.StructType([T.StructField("posted_date", T.DateType(), True)])

AUDIT_LOG = T.StructType(
    [
        T.StructField("timestamp", S, False),
        T.StructField("log_level", S, False),
        T.StructField("log_class", S, False),
        T.StructField("app_name", S, False),
        T.StructField("line_num", T.IntegerType(), True),
        T.StructField("message", S, False),
    ]
)

FACT_COLUMNS = [f.name for f in LEDGER_FACT.fields]


def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a table by catalog name or by path.

    ``source`` containing a ``/`` is a path read with ``fmt``; anything else
    is a catalog table name.  A given schema is enforced: a missing column
    or another type raises ``TypeError`` (a double amount would break exact
    sums silently).
    """
    if "/" in source or source.startswith("file:"):
        reader = spark.read.format(fmt)
        if schema is not None and fmt != "parquet":
            reader = reader.schema(schema)
        found = reader.load(source)
    else:
        found = spark.table(source)
    types = {f.name.lower(): f.dataType for f in found.schema.fields}
    for f in schema.fields if schema is not None else []:
        if types.get(f.name.lower()) != f.dataType:
            raise TypeError(f"{source}: column {f.name} is {types.get(f.name.lower())}, not {f.dataType}")
    return found


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """Read a relational table (connection options come from the caller)."""
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def read_ledger_fact(spark: SparkSession, source: str) -> DataFrame:
    return read_table(spark, source, LEDGER_FACT)


def read_leaves(spark: SparkSession, source: str) -> DataFrame:
    return read_table(spark, source, LEAVES)


def read_operators(spark: SparkSession, source: str) -> DataFrame:
    return read_table(spark, source, OPERATORS)


def read_stored_counts(spark: SparkSession, source: str) -> DataFrame:
    return read_table(spark, source, STORED_COUNTS)


def read_posted_dates(spark: SparkSession, source: str) -> DataFrame:
    return read_table(spark, source, POSTED_DATES)
