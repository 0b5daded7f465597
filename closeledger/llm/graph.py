"""Connected components of a stored edge table, by alternating large-star and
small-star steps (Kiveris et al., "Connected components in MapReduce and
beyond", 2014).  Every step is a partial aggregate and a join; no neighbourhood
is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeledger.llm.common import stored, stored_with


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    ends = F.explode(F.array("u", "v")).alias("u")
    return joined.select(ends, F.col("m").alias("v")).where("u > v").distinct()


def stars(edges: DataFrame, steps: int | None = None) -> DataFrame:
    """Edges (u, v), u > v, that join the same nodes as ``edges`` (long columns
    u, v): from every node but the roots to its root, the component's smallest
    node.  With ``steps``, no more pairs of star steps than that are made, and a
    node may have several edges."""
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    state = None
    while True:
        # the second step reads the first one's edges twice
        now = stored(_star(now, True), "large-stars")
        now, after = stored_with(_star(now, False), "stars", n=F.count("*"), mark=F.bit_xor(F.xxhash64("u", "v")))
        steps = None if steps is None else steps - 1
        if after == state or steps == 0:
            return now
        state = after


def roots_of(edges: DataFrame) -> DataFrame:
    """node, root of ``stars``; nodes of one root are in one component, but
    where steps were limited a component may have several roots."""
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` but the roots themselves."""
    return stars(edges).select(F.col("u").alias("node"), F.col("v").alias("root"))
