"""A bit filter over 64-bit hashes, made by Spark and of fixed size.

Used to leave out rows that cannot matter before they are shuffled.  A hash
that was put in is always let through; one that was not may be, which costs
work and never changes a result.  The filter has ``2**bits`` bits at every
size of the data, so it is safe to broadcast.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB of bits, in 2^20 words.
BITS = 26


def _word(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 70 - bits)


def _bit(h: Column, bits: int) -> Column:
    place = F.shiftrightunsigned(h, 64 - bits).bitwiseAND(F.lit(63).cast("long")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bit_words(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """At most 2^(bits - 6) rows: number of a 64-bit word and its bits."""
    h = F.col(column)
    return df.groupBy(_word(h, bits).alias("word")).agg(F.bit_or(_bit(h, bits)).alias("mask"))


def keep_rows(df: DataFrame, column: str, words: DataFrame, bits: int = BITS, let_through: bool = True) -> DataFrame:
    """Rows of ``df`` whose hash passes the filter (or the others)."""
    w = F.broadcast(words.select(F.col("word").alias("__word"), F.col("mask").alias("__mask")))
    joined = df.join(w, _word(F.col(column), bits) == F.col("__word"), "left")
    hit = F.coalesce(F.col("__mask"), F.lit(0).cast("long")).bitwiseAND(_bit(F.col(column), bits)) != 0
    return joined.where(hit if let_through else ~hit).drop("__word", "__mask")


class BitFilter:
    """The same filter for numpy code inside tasks."""

    def __init__(self, words: DataFrame, bits: int = BITS):
        self.bits = bits
        self.masks = np.zeros(1 << (bits - 6), np.uint64)
        rows = words.toArrow()
        self.masks[rows.column("word").to_numpy().astype(np.int64)] = rows.column("mask").to_numpy().astype(np.int64).view(np.uint64)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        word = (hashes >> np.uint64(70 - self.bits)).astype(np.int64)
        bit = (hashes >> np.uint64(64 - self.bits)) & np.uint64(63)
        return (self.masks[word] >> bit) & np.uint64(1) != 0
