"""Small in-row filters over a dictionary, built by one aggregate and held as one array.

A filter is a one-row DataFrame with an array of 64-bit words. It is used as a
scalar subquery: Spark computes it once per query, next to the plan that needs
it, and each task looks words up in constant time. A filter may let strangers
through, never the other way round, so the join behind it stays exact; its size
is bounded whatever the dictionary's size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of an array at most: 16 MB, sent with the stage that uses it.
WORDS_MAX = 1 << 21
# Bits of a Bloom filter per key. Below the second number a filter would let too much through and is left out.
BITS_PER_KEY, BITS_PER_KEY_MIN = 16, 4
# Bits that a key sets in its word of the Bloom filter.
KEY_BITS = 4
# Phrases of this many words or more share one bit of the first-word index.
LONG_PHRASE = 63


def _power_of_two(n: float) -> int:
    return 1 << max(4, math.ceil(math.log2(max(n, 1))))


def _place(value: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(words)).cast("int")


def _one(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bits.cast("int"))


def _array(spark: SparkSession, entries: DataFrame, words: int) -> DataFrame:
    """One row with the array whose word at ``place`` has all ``bits`` of the entries (place, bits), 0 without any."""
    empty = spark.range(words).select(F.col("id").cast("int").alias("place"), F.lit(0).cast("bigint").alias("bits"))
    filled = entries.select("place", "bits").union(empty).groupBy("place").agg(F.bit_or("bits").alias("bits"))
    # At most WORDS_MAX rows, by the size of the array.
    ordered = F.sort_array(F.collect_list(F.struct("place", "bits")))
    return filled.agg(F.transform(ordered, lambda e: e["bits"]).alias("bits"))


class KeyFilter:
    """A Bloom filter over the values of a column; every key sets a few bits of one word."""

    def __init__(self, keys: DataFrame, column: str, n_keys: int):
        self.words = min(_power_of_two(n_keys * BITS_PER_KEY / 64), WORDS_MAX)
        entries = keys.select(_place(F.col(column), self.words).alias("place"), self._mask(F.col(column)).alias("bits"))
        self.frame = _array(keys.sparkSession, entries, self.words)

    @staticmethod
    def useful(n_keys: int) -> bool:
        """Whether an array of the largest size has enough bits for so many keys."""
        return 64 * WORDS_MAX >= n_keys * BITS_PER_KEY_MIN

    @staticmethod
    def _mask(value: Column) -> Column:
        h = F.xxhash64(value, F.lit(1))
        out = _one(F.pmod(h, F.lit(64)))
        for k in range(1, KEY_BITS):
            out = out.bitwiseOR(_one(F.pmod(F.shiftright(h, 8 * k), F.lit(64))))
        return out

    def bits(self) -> Column:
        return self.frame.scalar()

    def may_have(self, value: Column, bits: Column) -> Column:
        """True for every key, and for few other values. ``bits`` is the filter's array (``bits()``, or a column of it)."""
        # The mask is written once: a filter computes an expression as often as it is written.
        return F.bitwise_not(F.get(bits, _place(value, self.words))).bitwiseAND(self._mask(value)) == 0


class FirstWordIndex:
    """Which lengths (in words) the phrases have that begin with a word: a bit for each length, by the word's hash."""

    def __init__(self, keyed: DataFrame, column: str, n_keys: int):
        self.words = min(_power_of_two(4 * n_keys), WORDS_MAX)
        key = F.col(column)
        length = F.least(F.size(F.split(key, " ")), F.lit(LONG_PHRASE))
        entries = keyed.select(_place(F.substring_index(key, " ", 1), self.words).alias("place"), _one(length).alias("bits"))
        self.frame = _array(keyed.sparkSession, entries, self.words)

    def bits(self) -> Column:
        return self.frame.scalar()

    def lengths_at(self, word: Column, bits: Column) -> Column:
        """The lengths of phrases that may begin with the word, as bits; 0 for most words that begin none."""
        return F.get(bits, _place(word, self.words))


def has_length(lengths: Column, n: Column) -> Column:
    """Whether the bits of an index allow phrases of n words."""
    return F.getbit(lengths, F.least(n, F.lit(LONG_PHRASE))) == 1
