"""Hierarchy membership on a flattened tree (treecd, node, leaf).

A leaf carries a one-letter type prefix (``D`` department, ``J`` project,
``S`` operating unit), so membership of a fact code is tested on
``letter || code``.  Two join shapes exist and must not be confused:

* membership (``IN (select leaf ...)``) never multiplies fact rows: the leaf
  set is de-duplicated (or the join is a left semi join);
* the inner join on the leaf table multiplies a fact row by the number of
  listings of its leaf under the node; the journal extracts keep that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeledger.functions.labels import tag
from closeledger.operators.dimension import DEFAULT_BROADCAST_ROWS, bounded, broadcast_or_restrict, hint, salted_join
from closeledger.operators.membership import membership_filter


def leaf_set(leaves: DataFrame, node: str, tree: str | None = None, distinct: bool = True) -> DataFrame:
    """Leaves under ``node`` (optionally restricted to one tree), one column
    ``leaf``.  ``distinct=False`` keeps duplicate listings."""
    cond = F.col("node") == F.lit(node)
    if tree is not None:
        cond = cond & (F.col("treecd") == F.lit(tree))
    out = leaves.filter(cond).select("leaf")
    return out.distinct() if distinct else out


def member_flag(
    df: DataFrame,
    key: Column,
    members: DataFrame,
    flag: str,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Add boolean column ``flag``: is ``key`` among ``members.leaf``?

    A left outer join against the de-duplicated member set, so no fact row is
    multiplied; a NULL key never matches (``flag`` is then False).  ``small``
    is the caller's size decision for ``members``; ``None`` checks it here.
    """
    if small is None:
        (small,) = bounded([members], max_broadcast_rows)
    probe = f"__leaf_{flag}"
    side = members.select(F.col("leaf").alias(probe)).distinct().withColumn(flag, F.lit(True))
    # the hint is re-applied after the distinct (a hint on the input of an
    # aggregate does not reach the join); an unproven side is joined salted
    if small:
        joined = df.join(hint(side, True), key == F.col(probe), "left")
    else:
        joined = salted_join(df, side, key, F.col(probe), "left")
    joined = joined.drop(probe)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def _join_leaf_side(df: DataFrame, key: Column, side: DataFrame, side_key: str, how: str, max_broadcast_rows: int) -> DataFrame:
    """Join ``df`` to a leaf side: broadcast when proven small (possibly
    after cutting it to the codes ``df`` uses), else salted, after a membership
    filter has dropped most lines without a partner."""
    [(side, small)] = broadcast_or_restrict([side], [side_key], [key], df, max_broadcast_rows)
    if small:
        return df.join(side, key == F.col(side_key), how)
    kept = membership_filter(side, side_key, max_broadcast_rows)
    return salted_join(df if kept is None else kept.keep(df, key), side, key, F.col(side_key), how)


def in_hierarchy(
    df: DataFrame,
    column: str,
    letter: str,
    leaves: DataFrame,
    node: str,
    tree: str | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Rows whose tagged code is a leaf under ``node`` (left semi join)."""
    side = leaf_set(leaves, node, tree).select(F.col("leaf").alias("__leaf"))
    return _join_leaf_side(df, tag(letter, df[column]), side, "__leaf", "left_semi", max_broadcast_rows)


def join_leaves(
    df: DataFrame,
    column: str,
    letter: str,
    leaves: DataFrame,
    node: str,
    tree: str | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Inner join on the leaf table: one output row per (fact row, listing)."""
    side = leaf_set(leaves, node, tree, distinct=False).select(F.col("leaf").alias("__leaf"))
    return _join_leaf_side(df, tag(letter, df[column]), side, "__leaf", "inner", max_broadcast_rows).drop("__leaf")


def duplicate_leaves(leaves: DataFrame) -> DataFrame:
    """Leaves listed more than once under one node, with the number of
    listings and of distinct trees.  A leaf in two trees under one node
    doubles amounts in the journal extracts' inner join."""
    return (
        leaves.groupBy("node", "leaf")
        .agg(F.count(F.lit(1)).alias("listings"), F.countDistinct("treecd").alias("trees"))
        .filter(F.col("listings") > 1)
    )


# Which fact column a leaf's type letter refers to.
LEAF_COLUMNS = {"D": "deptid", "J": "project_id", "S": "operating_unit"}


def duplicate_leaf_impact(
    fact: DataFrame,
    leaves: DataFrame,
    columns: dict[str, str] | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``duplicate_leaves`` plus ``lines``: the fact lines carrying each
    duplicated leaf code (the lines whose amounts an inner join on the leaf
    table multiplies).  One scan of the fact: its tagged codes are exploded
    into one column and joined to the (size-checked) duplicates, and the
    count is partially aggregated before its shuffle."""
    columns = columns or LEAF_COLUMNS
    dups = duplicate_leaves(leaves)
    codes = fact.select(F.explode(F.array(*[tag(letter, F.col(c)) for letter, c in columns.items()])).alias("__code"))
    codes = codes.filter(F.col("__code").isNotNull())
    keys = dups.select(F.col("leaf").alias("__dup")).distinct()
    [(keys, small)] = broadcast_or_restrict([keys], ["__dup"], [F.col("__code")], codes, max_broadcast_rows)
    code, dup = F.col("__code"), F.col("__dup")
    hits = codes.join(keys, code == dup, "inner") if small else salted_join(codes, keys, code, dup, "inner")
    lines = hits.groupBy(F.col("__dup").alias("leaf")).agg(F.count(F.lit(1)).alias("lines"))
    return dups.join(lines, "leaf", "left").select(
        "node", "leaf", "listings", "trees", F.coalesce(F.col("lines"), F.lit(0)).alias("lines")
    )
