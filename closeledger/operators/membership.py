"""Membership filter: drop lines that are in no large leaf set before a shuffle.

A leaf set that is too large to broadcast is folded into a table of 64-bit words:
a code picks one word by its hash and sets ``MARKS`` of its bits (a blocked Bloom
filter).  The number of words follows the number of codes, and the table is
broadcast, as it is never larger than the bound it is given.  A line whose code is
in the set always passes; of the others a share passes that the table itself
tells (``false_share``).  So the shuffle join behind it moves members and that
share, not all lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeledger.operators.dimension import DEFAULT_BROADCAST_ROWS

#: Bits per code while the table is within its bound, and bits that a code sets.
BITS_PER_CODE, MARKS = 16, 5
#: Share of passing non-members beyond which a filter is not worth its broadcast.
WORTH = 0.5


def _word(code: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(code), F.lit(words).cast("long"))


def _marks(code: Column) -> Column:
    """The bits of a code in its word."""
    h = F.xxhash64(F.lit(1), code)
    bits = F.lit(0).cast("long")
    for i in range(MARKS):
        # the Python form of shiftleft takes no column as distance
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(63).cast("int")))
    return bits


@dataclass(frozen=True)
class MembershipFilter:
    words: int
    table: DataFrame  # __word, __bits; at most ``words`` rows
    false_share: float

    def flag(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with ``name``: may ``key`` be a member?  (NULL: no.)"""
        joined = df.join(F.broadcast(self.table), _word(key, self.words) == F.col("__word"), "left")
        passes = key.isNotNull() & (F.col("__bits").bitwiseAND(_marks(key)) == _marks(key))
        return joined.withColumn(name, F.coalesce(passes, F.lit(False))).drop("__word", "__bits")

    def keep(self, df: DataFrame, key: Column) -> DataFrame:
        """Lines of ``df`` whose ``key`` may be a member."""
        return self.flag(df, key, "__maybe").filter("__maybe").drop("__maybe")


def membership_filter(members: DataFrame, code: str, max_words: int = DEFAULT_BROADCAST_ROWS) -> MembershipFilter | None:
    """Filter for the values of ``code``, of at most ``max_words`` words; None
    where so few words could not tell much.  Two small jobs over the members."""
    n = members.select(code).count()
    words = min(max(1, -(-n * BITS_PER_CODE // 64)), max_words)
    if words <= 0:
        return None
    found = members.filter(F.col(code).isNotNull()).select(_word(F.col(code), words).alias("__word"), _marks(F.col(code)).alias("__bits"))
    table = found.groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    # a non-member passes a word with share f of its bits set with chance f ** MARKS
    filled = F.pow(F.bit_count("__bits") / F.lit(64.0), F.lit(MARKS))
    share = float(table.agg(F.coalesce(F.sum(filled), F.lit(0.0)).alias("s")).first()["s"]) / words
    return MembershipFilter(words, table, share) if share <= WORTH else None
