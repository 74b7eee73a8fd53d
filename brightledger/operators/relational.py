"""Joins and set operations whose null handling or skew behaviour needs care."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, key: Column, values: DataFrame, surely_lacking: DataFrame | None = None) -> DataFrame:
    """SQL ``key NOT IN (values)`` as a distributed anti join.

    A null among the values removes every row, a null key is removed unless the list
    is empty. Spark plans ``NOT IN`` as a broadcast of the whole list, which grows
    with the data; here only a one-row summary reaches every task. Rows of ``surely_lacking``, whose keys are known to be absent, follow the same
    rules for nulls and are not joined.
    """
    value = values.columns[0]
    listed = values.select(F.col(value).alias("__listed"))
    facts = F.struct((F.count(F.lit(1)) == 0).alias("empty"), (F.count(F.lit(1)) > F.count("__listed")).alias("holds_null"))
    summary = listed.agg(facts.alias("s")).scalar()
    allowed = summary["empty"] | (~summary["holds_null"] & F.col("__key").isNotNull())
    kept = left.withColumn("__key", key).join(listed.where("__listed is not null").distinct(), F.col("__key") == F.col("__listed"), "left_anti")
    if surely_lacking is not None:
        kept = kept.unionByName(surely_lacking.withColumn("__key", key))
    return kept.where(allowed).drop("__key")


def semi_in(left: DataFrame, key: Column, values: DataFrame) -> DataFrame:
    """SQL ``key IN (values)``; the list is made distinct so a hot value is joined once."""
    value = values.columns[0]
    listed = values.select(F.col(value).alias("__listed")).where("__listed is not null").distinct()
    return left.withColumn("__key", key).join(
        listed, F.col("__key") == F.col("__listed"), "left_semi").drop("__key")


def split_sources(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of ``left`` only, of ``right`` only, and of ``right`` whose key is in both."""
    lk, rk = left.select(key).distinct(), right.select(key).distinct()
    return (left.join(rk, key, "left_anti"), right.join(lk, key, "left_anti"),
            right.join(lk, key, "left_semi"))


def latest_per_group(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Rows that hold the largest ``by`` of their null-safe group, ties kept.

    The maximum is taken with partial aggregation and joined back, so a group that
    holds a large share of the rows is never gathered in one task before it is small.
    """
    top = df.groupBy(*keys).agg(F.max(by).alias("__top"))
    renamed = top.select(*[F.col(k).alias(f"__{k}") for k in keys], "__top")
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(renamed, cond & (F.col(by) == F.col("__top")), "left_semi")


#: Days are counted from here, so that their numbers are not negative.
FIRST_DAY = "0001-01-01"


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")


def _cells(start: Column, end: Column, levels: int) -> list[Column]:
    """(level, block) of each block that the days from ``start`` to ``end`` may have, null where they have it not; two per level."""
    cells = []
    low, high = _day_number(start), _day_number(end) + 1
    for k in range(levels):
        size = F.lit(1 << k).cast("long")
        first, beyond = F.floor((low + size - 1) / size).cast("long"), F.floor(high / size).cast("long")
        cells.append(F.when((first % 2 == 1) & (first < beyond), F.struct(F.lit(k).alias("level"), first.alias("block"))))
        cells.append(F.when((beyond % 2 == 1) & (first + first % 2 < beyond), F.struct(F.lit(k).alias("level"), (beyond - 1).alias("block"))))
    return cells


def interval_cells(start: Column, end: Column, levels: int) -> Column:
    """The days from ``start`` to ``end`` as aligned blocks of a power of two days: array of (level, block), at most two per level."""
    return F.filter(F.array(*_cells(start, end, levels)), lambda c: c.isNotNull())


def join_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], day: str, start: str, end: str) -> DataFrame:
    """Each (keys, ``day``) of ``points`` with the intervals of the same keys that hold the day.

    An interval becomes its few blocks of days, whatever its length, and a day meets one block of each size by equality, so neither
    calendar days nor pairs are enumerated. Blocks of an odd level are halved, so that a day has half as many rows. ``points`` should be
    distinct; they are read twice, as intervals of keys that no point has leave first. Rows with a null key or day, and intervals that are
    empty or have a null end, match nothing. The sizes of exploded rows are not known to Spark, which would broadcast them: the join shuffles.
    """
    real = intervals.where(F.col(end) >= F.col(start))
    longest = real.agg(F.max(F.datediff(end, start))).first()[0]
    levels = (0 if longest is None else longest + 1).bit_length() + 1
    real = real.join(points.select(*keys).distinct(), keys, "left_semi")
    cells = real.select("*", F.inline(F.array(*_cells(F.col(start), F.col(end), levels)))).where("level IS NOT NULL")
    halves = F.when(F.col("level") % 2 == 1, F.array(F.col("block") * 2, F.col("block") * 2 + 1)).otherwise(F.array("block"))
    blocks = cells.select(*intervals.columns, (F.col("level") - F.col("level") % 2).alias("level"), F.explode(halves).alias("block"))
    sizes = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(_day_number(F.col(day)) / (1 << k)).cast("long").alias("block")) for k in range(0, levels, 2)])
    asked = points.where(F.col(day).isNotNull()).select("*", F.inline(sizes))
    return asked.join(blocks.hint("merge"), [*keys, "level", "block"]).drop("level", "block")
