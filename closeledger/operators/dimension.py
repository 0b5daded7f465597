"""Size-checked broadcast of dimension-side inputs, and the joins beyond it.

A broadcast ships the whole side to every executor, so it is only safe for
data whose size is proven.  The proof is a count of the rows and of the bytes of
the (filtered) side, taken before any de-duplication so it bounds the
de-duplicated set too.  All sides an extract needs are measured in **one** small
job (a union of the sides grouped by side number); it reads dimension tables,
never the fact.

A side beyond the bound is first cut down to the keys the fact lines
actually carry (``restrict_to_used``: a distinct of the fact's join key,
partially aggregated before its small shuffle, semi-joined with the side)
and measured again: a department tree with millions of leaves still meets
only the departments that post in the period.  Only if that is still too
large does the join go without the hint, as a **salted** shuffle join
(``salted_join``).  Its hot keys come from a mergeable frequent-items sketch of
the lines (``hot_keys``): lines of a hot key get a deterministic salt from a hash
of their columns and the dimension rows of that key are repeated once per salt
value, so a key holding a third of the lines is spread over ``SALT_BUCKETS`` join
partitions; all other lines and dimension rows move once, unsalted.  The landing
and journal extracts also pre-aggregate lines to groups before such a join (exact
for sums), so it moves groups, not lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a narrow key table (a code and a flag or a name), and their bytes, that
# we are willing to ship to every executor.
DEFAULT_BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# Join partitions a hot key is spread over on the shuffle-join path.
SALT_BUCKETS = 32
# A key with more than one in HOT_SHARE of the lines is hot; the sketch tracks
# SKETCH_ITEMS keys, so that no such key escapes it.
HOT_SHARE, SKETCH_ITEMS = 256, 8192


def bounded(sides: list[DataFrame], max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> list[bool]:
    """For each side: has it at most ``max_rows`` rows and ``max_bytes`` bytes
    of values?  One job."""
    if max_rows <= 0 or not sides:
        return [False] * len(sides)

    def size(side: DataFrame) -> Column:
        widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in side.columns]
        return reduce(lambda a, b: a + b, widths, F.lit(8)).cast("long")

    tagged = [s.select(F.lit(i).alias("__side"), size(s).alias("__bytes")) for i, s in enumerate(sides)]
    counts = reduce(lambda a, b: a.unionByName(b), tagged).groupBy("__side").agg(F.count(F.lit(1)).alias("n"), F.sum("__bytes").alias("b"))
    sizes = {r["__side"]: (r["n"], r["b"]) for r in counts.collect()}  # at most len(sides) rows
    found = [sizes.get(i, (0, 0)) for i in range(len(sides))]
    return [n <= max_rows and b <= max_bytes for n, b in found]


def hint(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side proven small; ask for a sort-merge (shuffle) join on
    any other, so no estimate-based broadcast of an unproven side happens."""
    return F.broadcast(df) if small else df.hint("merge")


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` if ``df`` is proven small, else
    ``(df, False)``."""
    (small,) = bounded([df], max_rows)
    return hint(df, small), small


def restrict_to_used(side: DataFrame, side_key: str, used: DataFrame) -> DataFrame:
    """Rows of ``side`` whose ``side_key`` occurs in ``used`` (one column
    ``__k`` of distinct fact keys).  A left semi join keeps duplicate
    listings of the side, so fan-out semantics are unchanged."""
    return side.join(used, F.col(side_key) == F.col("__k"), "left_semi")


def used_keys(df: DataFrame, key) -> DataFrame:
    """Distinct non-NULL join keys of the fact lines, column ``__k``."""
    return df.select(key.alias("__k")).filter(F.col("__k").isNotNull()).distinct()


def broadcast_or_restrict(
    sides: list[DataFrame],
    side_keys: list[str],
    fact_keys: list,
    lines: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
) -> list[tuple[DataFrame, bool]]:
    """For each dimension side: broadcast it if its size is proven small;
    else restrict it to the keys ``lines`` use and re-check; else return it
    for a shuffle join.  At most two count jobs."""
    smalls = bounded(sides, max_rows)
    out: list[tuple[DataFrame, bool]] = [(s, ok) for s, ok in zip(sides, smalls)]
    large = [i for i, ok in enumerate(smalls) if not ok]
    if large and max_rows > 0:
        cut = {i: restrict_to_used(sides[i], side_keys[i], used_keys(lines, fact_keys[i])) for i in large}
        recheck = bounded([cut[i] for i in large], max_rows)
        for i, ok in zip(large, recheck):
            out[i] = (cut[i], ok)
    return [(hint(s, ok), ok) for s, ok in out]


def hot_keys(lines: DataFrame, keys: list[Column], share: int = HOT_SHARE) -> list[list]:
    """For each key: its values that more than one in ``share`` of the lines
    carry (fewer than ``share`` values).  One job over the lines; tasks merge
    sketches of a fixed size, and a sketch never misses a value that common.  A
    value that it lists without need costs some repeated dimension rows."""
    named = lines.select(*[k.alias(f"__k{i}") for i, k in enumerate(keys)])
    top = [F.expr(f"approx_top_k(__k{i}, {share}, {SKETCH_ITEMS}) FILTER (WHERE __k{i} IS NOT NULL)").alias(f"t{i}") for i in range(len(keys))]
    row = named.agg(F.count(F.lit(1)).alias("n"), *top).first()
    return [[e["item"] for e in row[f"t{i}"] or () if e["count"] * share > row["n"]] for i in range(len(keys))]


def repeat_hot(right: DataFrame, key: Column, hot: list, buckets: int = SALT_BUCKETS) -> DataFrame:
    """Dimension rows with ``__salt_r``: those of a hot key once per salt
    value, the others once."""
    many, one = F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long")), F.array(F.lit(0).cast("long"))
    return right.withColumn("__salt_r", F.explode(F.when(key.isin(hot), many).otherwise(one)))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    how: str,
    hot: list | None = None,
    buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Shuffle join of ``left`` (many lines, possibly a hot key) with
    ``right`` (a dimension too large to broadcast) on ``left_key == right_key``.

    ``hot`` lists the left side's hot keys (default: found by ``hot_keys``).  The
    salt of a line is ``pmod(xxhash64(all its columns), buckets)`` for a hot key,
    else 0: deterministic, so a retried task sends every line to the same
    partition.  Right rows of a hot key are repeated for every salt value, others
    stand once with salt 0; as the condition also requires equal salts, each
    (line, dimension row) pair still meets exactly once, so inner, left and
    left-semi results are unchanged.
    """
    (hot,) = hot_keys(left, [left_key]) if hot is None else (hot,)
    if not hot:
        return left.join(right.hint("merge"), left_key == right_key, how)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(buckets))
    salted_left = left.withColumn("__salt", F.when(left_key.isin(hot), salt).otherwise(F.lit(0).cast("long")))
    joined = salted_left.join(repeat_hot(right, right_key, hot, buckets).hint("merge"), (left_key == right_key) & (F.col("__salt") == F.col("__salt_r")), how)
    return joined.drop("__salt", "__salt_r")
