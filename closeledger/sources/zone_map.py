"""Zone map of a stored ledger: which files can hold which lines.

A table with one row per file of the fact: its rows, and the least and greatest
period and codes.  It is read from the Parquet footers, in parallel, without
touching data, and kept as a table beside the fact; ``refresh`` reads only the
footers of files that are new.  ``matching`` asks it for the files that can hold
a period's lines of some rules, so that Spark plans and opens those files only,
however many the fact has.  A file without statistics of a column always matches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.operators.rules import SegmentRule
from closeledger.session import ship_package
from closeledger.sinks.copies import hadoop_path, open_uri
from closeledger.sources.schema import FACT_COLUMNS, LEDGER_FACT

#: Columns the extracts filter on.
ZONED = ("drill_date", "ledger", "business_unit", "operating_unit", "account", "deptid")


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes) of the Parquet files under ``path``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def zones(files: DataFrame, columns: Sequence[str] = ZONED) -> DataFrame:
    """One row per file (column ``file``): rows, and lo_c and hi_c as text for
    each column (null: not known)."""
    names, spark = list(columns), files.sparkSession
    ship_package(spark)

    def footer(uri: str) -> tuple:
        at, path = open_uri(uri)
        with at.open_input_file(path) as f:
            meta = pq.ParquetFile(f).metadata
        held = dict(p.split("=", 1) for p in uri.split("/")[:-1] if "=" in p)
        place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        out = [uri, meta.num_rows]
        for c in names:
            stats = [meta.row_group(g).column(place[c]).statistics for g in range(meta.num_row_groups)] if c in place else []
            if c in held:
                low = high = unquote(held[c])
            elif stats and all(s is not None and s.has_min_max for s in stats):
                low, high = min(s.min for s in stats), max(s.max for s in stats)
            else:
                low = high = None
            out += [None if v is None else v if isinstance(v, str) else str(v) for v in (low, high)]
        return tuple(out)

    schema = ", ".join(["file string", "rows long", *[f"{p}_{c} string" for c in names for p in ("lo", "hi")]])
    kinds = [pa.string(), pa.int64(), *[pa.string()] * (2 * len(names))]
    labels = [c.rsplit(" ", 1)[0] for c in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [footer(u) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names=labels)

    tasks = files.select("file").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file")
    return tasks.mapInArrow(read, schema)


def refresh(spark: SparkSession, fact_path: str, map_path: str, columns: Sequence[str] = ZONED) -> DataFrame:
    """Bring the stored zone map in line with the files that are there."""
    now = listed_files(spark, fact_path).select("file")
    files, place = hadoop_path(spark, map_path)
    if not files.exists(place):
        zones(now, columns).write.parquet(map_path)
        return spark.read.parquet(map_path)
    old = spark.read.parquet(map_path)
    kept, new = old.join(now, "file", "left_semi"), now.join(old.select("file"), "file", "left_anti")
    whole = kept.unionByName(zones(new, columns)).checkpoint(eager=True)  # read in full before it is replaced
    whole.write.mode("overwrite").parquet(map_path)
    return spark.read.parquet(map_path)


def _within(column: str, low: str, high: str) -> Column:
    """Can a file hold a value between ``low`` and ``high``?"""
    lo, hi = F.col(f"lo_{column}"), F.col(f"hi_{column}")
    return lo.isNull() | hi.isNull() | ((lo <= F.lit(high)) & (hi >= F.lit(low)))


def may_hold(rule: SegmentRule, columns: Sequence[str] = ZONED) -> Column:
    """Can a file hold a line of ``rule``, by its codes and accounts?"""
    parts = [_within(c, v, v) for c, v in rule.codes if c in columns]
    if rule.account_column in columns and (rule.account_range is not None or rule.account_list):
        spans = [(a, a) for a in rule.account_list] + ([rule.account_range] if rule.account_range is not None else [])
        parts.append(reduce(lambda a, b: a | b, [_within(rule.account_column, *s) for s in spans]))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def matching(zone_map: DataFrame, period, rules: Sequence[SegmentRule] = ()) -> list[str]:
    """Files that can hold lines of ``period`` and, if given, of a rule."""
    columns = [c.removeprefix("lo_") for c in zone_map.columns if c.startswith("lo_")]
    found = zone_map.filter(_within("drill_date", period.isoformat(), period.isoformat()) & (F.col("rows") > 0))
    if rules:
        found = found.filter(reduce(lambda a, b: a | b, [may_hold(r, columns) for r in rules]))
    return [r["file"] for r in found.select("file").orderBy("file").collect()]


def read_matching(spark: SparkSession, fact_path: str, zone_map: DataFrame, period, rules: Sequence[SegmentRule] = ()) -> DataFrame:
    """The fact, cut to the files that ``matching`` names.  The extracts'
    own filters still apply to its rows."""
    files = matching(zone_map, period, rules)
    if not files:
        return spark.createDataFrame([], LEDGER_FACT)
    base = hadoop_path(spark, fact_path)[1].toString()
    return spark.read.schema(LEDGER_FACT).option("basePath", base).parquet(*files).select(*FACT_COLUMNS)
