"""Balances at a grain and the non-zero test.

``sum`` over decimals is exact; Spark combines partial sums map-side before
the shuffle, so a hot key (one account holding a third of the lines) sends
one partial row per map task, not its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeledger.functions.labels import MONEY


def balance(df: DataFrame, keys: list[str | Column], amount: str = "amount", name: str = "amt", cast: str | None = MONEY) -> DataFrame:
    """``sum(amount)`` per group of raw ``keys`` (cast to ``cast`` if given)."""
    total = F.sum(amount)
    if cast is not None:
        total = total.cast(cast)
    return df.groupBy(*keys).agg(total.alias(name))


def nonzero(df: DataFrame, amt: str = "amt") -> DataFrame:
    """Keep groups whose *rounded* balance is not zero (NULL balances drop)."""
    return df.filter(F.col(amt).cast(MONEY) != F.lit(0))


def nonzero_keys(df: DataFrame, keys: list[str], amount: str = "amount") -> DataFrame:
    """Distinct key tuples with a non-zero rounded balance; no amount output."""
    return df.groupBy(*keys).agg(F.sum(amount).cast(MONEY).alias("__amt")).filter(F.col("__amt") != F.lit(0)).drop("__amt")
