"""Ledger inputs derived from the driver's TPC-H-like tables.

The test tables hold no ledger, so a ledger fact, a hierarchy leaf map, an
operator dimension and a table of already-extracted posting dates are
derived from ``lineitem``, ``nation``, ``region`` and ``customer`` (the
derivation is specified in FIXTURES.md; the DuckDB oracle uses that SQL
text, this module re-states it for Spark).

The fact is built from **one** scan of ``lineitem``: the five variants of a
line (original, reversal, late posting, unquoted twin, second operator id)
are produced by exploding an array of variant numbers instead of a five-way
UNION ALL that would scan the table five times.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.sources.schema import FACT_COLUMNS

# Fixed values of the fixture: node names are neutral stand-ins, the period
# and bounds are those the golden row counts were taken with.
FIXTURE_PERIOD = dt.date(1998, 4, 1)
FIXTURE_RUN_DATE = dt.date(1998, 5, 5)
FIXTURE_WATERMARK = dt.date(1998, 5, 31)
FIXTURE_RUN_TS = dt.datetime(1998, 5, 5, 14, 30, 15, 250000)
DEPT_TREE, DEPT_NODE = "DEPT", "DEPT_ROOT"
PROJ_TREE, PROJ_NODE = "PROJ", "CAPITAL_PROJ"
OPER_NODE = "OPER_GROUP"


# Declared schemas of the driver's tables: reading with a known schema skips
# footer-based schema inference (a job per read, and a footer read per file
# on a large table).
TABLE_SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read with its declared schema."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


_table = table


def _rows(spark: SparkSession, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """A handful of literal string rows, built in the JVM (no Python-side RDD)."""
    structs = ", ".join(
        "struct(" + ", ".join(f"'{v}' AS {n}" for n, v in zip(names, r)) + ")" for r in rows
    )
    return spark.range(1).selectExpr(f"inline(array({structs}))")


# Per-line derivation of the fact (FIXTURES.md section 2).  The last column
# lists the variant numbers of a line: 0 original, 1 reversal, 2 late
# posting, 3 unquoted twin, 4 second operator id (NULL: not a variant of it).
_BASE_COLUMNS = [
    "concat(lpad(cast(CASE WHEN l_partkey % 10 = 0 THEN 15050 + 5 * (l_suppkey % 4) "
    "ELSE 10000 + (l_partkey * 7919) % 90000 END AS string), 5, '0'), "
    "CASE WHEN l_orderkey % 5 = 0 THEN ' ' ELSE '' END) AS account",
    "CASE WHEN l_returnflag = 'A' AND l_linenumber % 2 = 0 THEN 'STAT' ELSE 'GAAP' END AS ledger",
    "trunc(to_date(l_shipdate), 'quarter') AS drill_date",
    "CASE WHEN l_linenumber = 7 THEN NULL "
    "ELSE concat(cast(l_partkey % 3 AS string), lpad(cast(l_partkey % 20 AS string), 4, '0')) END AS project_id",
    "CASE WHEN l_suppkey % 10 = 9 THEN '10010' ELSE '20020' END AS business_unit",
    "CASE WHEN l_linenumber <= 3 THEN '02858' WHEN l_linenumber <= 5 THEN '01000' ELSE '03000' END AS operating_unit",
    "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE concat(' L', cast(l_suppkey % 4 AS string)) END AS location",
    "CASE WHEN l_suppkey % 2 = 0 THEN '220210' "
    "ELSE concat('2203', lpad(cast(l_suppkey % 10 AS string), 2, '0')) END AS deptid",
    "concat('line \"', l_linestatus, '\"') AS line_descr",
    "concat(l_returnflag, ' ') AS descr",
    "concat('x', cast(l_linenumber % 2 AS string)) AS descr254",
    "concat('U', cast(l_orderkey % 50 AS string)) AS oprid",
    "l_linestatus AS source",
    "concat('JN', cast(l_orderkey % 97 AS string)) AS journal_id",
    "CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE date_add(to_date(l_shipdate), l_linenumber) END AS posted_date",
    "'N' AS reversal_cd",
    "cast(CASE WHEN l_orderkey % 40 = 1 THEN 0 "
    "ELSE cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2))) END AS decimal(19,4)) AS amount",
    "array(0, CASE WHEN l_orderkey % 4 = 0 THEN 1 END, CASE WHEN l_orderkey % 6 = 1 THEN 2 END, "
    "CASE WHEN l_orderkey % 7 = 1 THEN 3 END, CASE WHEN l_orderkey % 50 = 30 THEN 4 END) AS variants",
]
_VARIANT_COLUMNS = [
    "account", "ledger", "drill_date", "project_id", "business_unit", "operating_unit", "location", "deptid",
    "CASE WHEN variant = 3 THEN concat('line  ', source, ' ') ELSE line_descr END AS line_descr",
    "descr",
    "CASE WHEN variant = 1 THEN 'x9' ELSE descr254 END AS descr254",
    "CASE WHEN variant = 4 THEN 'U31' ELSE oprid END AS oprid",
    "source",
    "journal_id",
    "CASE WHEN variant = 2 THEN date_add(posted_date, 3) ELSE posted_date END AS posted_date",
    "CASE WHEN variant = 1 THEN 'Y' ELSE reversal_cd END AS reversal_cd",
    "cast(CASE WHEN variant = 1 THEN -amount ELSE amount END AS decimal(19,4)) AS amount",
]


def ledger_fact(spark: SparkSession, sf_dir: str, period: dt.date | None = None) -> DataFrame:
    """The ledger fact (schema ``LEDGER_FACT``).

    ``drill_date`` is the quarter of the ship date.  When ``period`` is
    given, the equivalent ship-date range is added as a plain predicate so
    the Parquet reader can skip row groups (the derived table has no
    directory partitions to prune).
    """
    li = _table(spark, sf_dir, "lineitem")
    if period is not None:
        lo = dt.datetime(period.year, period.month, 1)
        hi_month = period.month + 3
        hi = dt.datetime(period.year + (hi_month - 1) // 12, (hi_month - 1) % 12 + 1, 1)
        # wall-clock literals from text: independent of any time zone
        lo_ts, hi_ts = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (lo, hi))
        li = li.filter((F.col("l_shipdate") >= lo_ts) & (F.col("l_shipdate") < hi_ts))

    # one projection of SQL expressions (parsed in the JVM: a single call
    # instead of hundreds of Column-builder round trips from Python)
    base = li.selectExpr(*_BASE_COLUMNS)
    fx = (
        base.selectExpr("*", "explode(variants) AS variant")
        .filter("variant IS NOT NULL")
        .selectExpr(*_VARIANT_COLUMNS)
    )
    return fx.select(*FACT_COLUMNS)


def leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened hierarchy (treecd, node, leaf) over every nation and every
    (region, nation) pair; a few leaves are listed twice and one leaf sits
    under the same node in two trees, on purpose.

    Leaves outside a rule's node are decoys: they stand under another node of
    its tree, and under its node in another tree, so that a rule that forgets
    either filter takes lines it should not."""
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    dept = nation.selectExpr("concat('D2203', lpad(cast(n_nationkey AS string), 2, '0')) AS leaf", "n_nationkey < 6 AS inside")
    # every (region, nation) pair: a nation's row lists all keys of `region`
    keys = region.agg(F.sort_array(F.collect_set("r_regionkey")).alias("keys"))
    proj = (
        nation.select("n_nationkey", F.explode(keys.scalar()).alias("r_regionkey"))
        .selectExpr(
            "concat('J', cast(r_regionkey AS string), lpad(cast(n_nationkey AS string), 4, '0')) AS leaf",
            "r_regionkey < 2 AND n_nationkey < 20 AS inside",
        )
    )

    def listed(rows: DataFrame, tree: str, node: str) -> DataFrame:
        places = [("inside", tree, node), ("NOT inside", tree, f"{node}_OTHER"), ("NOT inside", f"{tree}_ALT", node)]
        parts = [rows.where(c).selectExpr(f"'{t}' AS treecd", f"'{n}' AS node", "leaf") for c, t, n in places]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    dept, proj = listed(dept, DEPT_TREE, DEPT_NODE), listed(proj, PROJ_TREE, PROJ_NODE)
    fixed = _rows(
        spark,
        ("treecd", "node", "leaf"),
        [
            (DEPT_TREE, DEPT_NODE, "D220210"),
            (DEPT_TREE, DEPT_NODE, "D220210"),
            ("OPER", OPER_NODE, "S01000"),
            ("OPER", OPER_NODE, "S02858"),
            ("OPER_ALT", OPER_NODE, "S01000"),
            ("OPER", f"{OPER_NODE}_OTHER", "S03000"),
        ],
    )
    return dept.unionByName(proj).unionByName(fixed)


def operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator dimension, one per customer: some names NULL, two ids share
    one name."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("U"), key.cast("string")).alias("employeeid"),
        F.when(key.isin(30, 31), F.lit("Shared Operator"))
        .when(key % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_name"))
        .alias("employeename"),
    )


def posted_dates(spark: SparkSession, sf_dir: str, through: dt.date = FIXTURE_WATERMARK) -> DataFrame:
    """Posting days already extracted by earlier runs: every posting day of
    the fact up to ``through``."""
    fact = ledger_fact(spark, sf_dir)
    return fact.select("posted_date").filter(F.col("posted_date") <= F.lit(through)).distinct()


@dataclass(frozen=True)
class LedgerTables:
    fact: DataFrame
    leaves: DataFrame
    operators: DataFrame
    posted_dates: DataFrame


def ledger_tables(spark: SparkSession, sf_dir: str, period: dt.date | None = None) -> LedgerTables:
    return LedgerTables(
        fact=ledger_fact(spark, sf_dir, period),
        leaves=leaves(spark, sf_dir),
        operators=operators(spark, sf_dir),
        posted_dates=posted_dates(spark, sf_dir),
    )

