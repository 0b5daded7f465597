"""Content reconciliation by multiset fingerprints.

Two sets of rows are equal as multisets when, segment by segment, their counts,
the sums of a 64-bit hash of the rows and the exclusive-or of a second one agree.
All three are order-free and mergeable, so a segment is folded map-side to one
row per task: extract and control go into one aggregate with opposite signs, and
what does not cancel names a segment that differs.  Only the rows of such
segments are then folded again, by group, to name the groups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Groups that an error message names.
NAMED = 5


@dataclass(frozen=True)
class ContentCheck:
    """An independent ``build`` of an extract's rows; ``segments`` are the
    columns that cut it into parts, ``keys`` those that name a group inside, and
    ``ignore`` those that may differ (a load timestamp)."""

    build: Callable[[SparkSession], DataFrame]
    segments: tuple[str, ...]
    keys: tuple[str, ...]
    ignore: tuple[str, ...] = ()


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _hashes(columns: list[str]) -> list[Column]:
    """Two hashes of a row that tell a null from any value, whatever stands
    beside it."""
    parts = [p for c in columns for p in (_quoted(c).isNull(), _quoted(c))]
    return [F.xxhash64(F.lit(i), *parts).alias(f"_h{i}") for i in (1, 2)]


def _signed(extract: DataFrame, control: DataFrame, check: ContentCheck) -> DataFrame:
    """Rows of both sides: segments, keys, sign and hashes."""
    named = [c for c in extract.columns if c not in check.ignore]
    missing = set(named) - set(control.columns)
    if missing:
        raise ValueError(f"the control has no column {sorted(missing)}")
    control = control.select(*[_quoted(c).cast(extract.schema[c].dataType).alias(c) for c in named])
    kept = [_quoted(c) for c in dict.fromkeys([*check.segments, *check.keys])]
    sides = [df.select(*kept, F.lit(sign).cast("long").alias("_sign"), *_hashes(named)) for df, sign in ((extract, 1), (control, -1))]
    return sides[0].unionByName(sides[1])


def _uncancelled(rows: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose two sides differ, with the rows of each side."""
    folded = rows.groupBy(*[_quoted(c) for c in by]).agg(
        F.count(F.when(F.col("_sign") == 1, 1)).alias("extract_rows"),
        F.count(F.when(F.col("_sign") == -1, 1)).alias("control_rows"),
        F.sum(F.col("_sign") * F.col("_h1").cast("decimal(20,0)")).alias("_sum"),
        F.bit_xor("_h2").alias("_xor"),
    )
    return folded.where((F.col("extract_rows") != F.col("control_rows")) | (F.col("_sum") != 0) | (F.col("_xor") != 0)).drop("_sum", "_xor")


def segment_differences(extract: DataFrame, control: DataFrame, check: ContentCheck) -> DataFrame:
    """Segments that differ: ``segments``, extract_rows, control_rows."""
    return _uncancelled(_signed(extract, control, check), list(check.segments))


def content_differences(extract: DataFrame, control: DataFrame, check: ContentCheck) -> DataFrame:
    """Groups that differ, of the segments that differ: ``segments``,
    ``keys``, extract_rows, control_rows (equal where only contents differ)."""
    rows = _signed(extract, control, check)
    bad = _uncancelled(rows, list(check.segments)).select(*[_quoted(c).alias(f"_bad_{i}") for i, c in enumerate(check.segments)])
    same = reduce(lambda a, b: a & b, [_quoted(c).eqNullSafe(F.col(f"_bad_{i}")) for i, c in enumerate(check.segments)])
    return _uncancelled(rows.join(bad, same, "left_semi"), list(dict.fromkeys([*check.segments, *check.keys])))


def check_contents(extract: DataFrame, control: DataFrame, check: ContentCheck) -> None:
    """Raise when an extract differs from its control, naming groups."""
    if segment_differences(extract, control, check).isEmpty():
        return
    found = content_differences(extract, control, check)
    names = [c for c in found.columns if c not in ("extract_rows", "control_rows")]
    some = [", ".join(f"{c}={r[c]}" for c in names) + f" ({r.extract_rows} rows, control {r.control_rows})" for r in found.limit(NAMED).collect()]
    raise ValueError(f"extract differs from its control in {found.count()} groups, such as: {'; '.join(some)}")
