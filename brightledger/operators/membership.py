"""Membership filters: most rows without a partner are known without a shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a key, and the bounds of a filter's size in 64-bit words (1 KiB to 8 MiB).
HASHES, LEAST_WORDS, MOST_WORDS = 4, 1 << 7, 1 << 20


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """(the word of a key, its bits there): all bits of a key are in one word, of which a power of two exists."""
    h = F.xxhash64(key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 24 + 6 * i).bitwiseAND(63).cast("int")) for i in range(HASHES)]
    return h.bitwiseAND(words - 1).cast("int"), reduce(Column.bitwiseOR, bits)


def bloom_filter(values: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(one row with the filter's words, their number) of the non-null values; ten bits a value up to a fixed size.

    The words are made by a distributed aggregate; beyond the fixed size a filter lets more through and is never wrong.
    """
    held = values.select(F.col(column).alias("v")).where("v IS NOT NULL")
    n = held.count()
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << (n * 10 // 64).bit_length()))
    at, mask = _place(F.col("v"), words)
    bits = held.select(at.alias("w"), mask.alias("bit"))
    none = values.sparkSession.range(words).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("bit"))
    merged = bits.unionByName(none).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    return merged.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("words")), words


def might_hold(key: Column, words: Column, n: int) -> Column:
    """Whether the filter may hold ``key``: false is certain. A null key gives null."""
    at, mask = _place(key, n)
    return F.when(key.isNotNull(), F.get(words, at).bitwiseAND(mask) == mask)
