"""Order alerts over a stream of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import from_micros, unit_no


def alert_windows(orders: DataFrame, key: str, minutes: int = 30, slide: int = 5, more_than: int = 2, one_amount: bool = True, lateness: str = "30 minutes") -> DataFrame:
    """Windows of ``minutes`` minutes, ``slide`` minutes apart, in which a key has over ``more_than`` orders, of one amount if ``one_amount``.

    (start, end, key, orders, lo, hi, first_to_last), each window once it is ``lateness`` behind the newest order. An order
    counts once within that lateness, however often it is sent, so that a plain count takes the place of a distinct one, which streams lack. A null
    key, id or time drops out. A batch of orders gives the same rows.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("created_at").cast("timestamp_ntz"))
    rows = orders.where(F.col(key).isNotNull() & F.col("created_at").isNotNull() & F.col("increment_id").isNotNull())
    rows = rows.select(F.timestamp_micros(micros).alias("ts"), F.col(key).alias("key"), "increment_id", "revenue").withWatermark("ts", lateness)
    once = rows.dropDuplicatesWithinWatermark(["increment_id"]) if orders.isStreaming else rows.dropDuplicates(["increment_id"])
    found = once.groupBy(F.window("ts", f"{minutes} minutes", f"{slide} minutes").alias("w"), "key").agg(
        F.count(F.lit(1)).alias("orders"), F.min("revenue").alias("lo"), F.max("revenue").alias("hi"), F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    found = found.where((F.col("orders") > more_than) & ((F.col("lo") == F.col("hi")) if one_amount else F.lit(True)))
    at = {n: from_micros(F.unix_micros(c)) for n, c in (("start", F.col("w.start")), ("end", F.col("w.end")), ("t0", F.col("t0")), ("t1", F.col("t1")))}
    return found.select(at["start"].alias("start"), at["end"].alias("end"), F.col("key").alias(key), "orders", "lo", "hi", (unit_no("MINUTE", at["t1"]) - unit_no("MINUTE", at["t0"])).alias("first_to_last"))
