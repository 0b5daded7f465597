"""Bit tables over 64-bit hashes: filters of a fixed size that are safe to
broadcast.  A table never misses a hash that was put in; when far more hashes
than bits are put in, it lets more through and stays right."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of a table's bits (2 MB).
BITS = 24


class Bits:
    """Bit table over hashes."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes.astype(np.uint64) & np.uint64((1 << BITS) - 1)
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def bit_words(rows: DataFrame, column: str) -> DataFrame:
    """Number and bits (w, b) of the words of a long column's table that are
    not 0; at most 2**BITS / 64."""
    return placed(rows, column).groupBy("w").agg(F.bit_or("b").alias("b"))


def placed(rows: DataFrame, column: str, *keep: str) -> DataFrame:
    """Word and bit (w, b) of a long column in the table, after ``keep``."""
    word = F.expr(f"shiftright({column} & {(1 << BITS) - 1}L, 6)")
    return rows.select(*keep, word.alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63L as int))").alias("b"))


def bit_table(rows: DataFrame, column: str = "digit") -> Bits:
    """Table of a long column; at most 2**BITS / 64 words reach the driver."""
    found = bit_words(rows, column).toArrow()
    table = np.zeros(1 << (BITS - 6), np.uint64)
    table[found["w"].to_numpy()] = found["b"].to_numpy().view(np.uint64)
    return Bits(table)


def among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose long column may be one of ``keys``' (columns of rows: not
    w or b).  Spark tests the words itself, so a task that reads rows needs no
    Python worker for it."""
    table = F.broadcast(bit_words(keys, column).withColumnRenamed("b", "bits"))
    found = placed(rows, column, *rows.columns).join(table, "w")
    return found.where(F.col("b").bitwiseAND(F.col("bits")) != 0).select(*rows.columns)
