"""Order alerts over the latest orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import to_zone, unit_no
from .web import LA


def latest_orders(orders: DataFrame, minutes: int) -> DataFrame:
    """Orders of the last ``minutes`` minutes before the newest one."""
    newest = orders.agg(F.max("created_at")).scalar()
    return orders.where(F.col("created_at") >= newest - F.expr(f"make_dt_interval(0, 0, {int(minutes)})"))


def order_groups(orders: DataFrame, key: str) -> DataFrame:
    """Distinct orders and amounts per key, and minutes between its first and last order."""
    ids = orders.groupBy(key, "increment_id").agg(F.min("revenue").alias("lo"), F.max("revenue").alias("hi"),
                                                  F.min("created_at").alias("t0"), F.max("created_at").alias("t1"))
    return ids.groupBy(key).agg(F.count("increment_id").alias("orders"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                (unit_no("MINUTE", F.max("t1")) - unit_no("MINUTE", F.min("t0"))).alias("first_to_last"))


def _with_visitors(rows: DataFrame, visitors: DataFrame, excluded: DataFrame) -> DataFrame:
    people = visitors.select("visitor_id", "user_pseudo_id", "country").distinct()
    banned = excluded.select("country").distinct()
    return rows.join(people, "visitor_id", "left").join(banned, "country", "left_anti")


def _pst() -> Column:
    return to_zone("created_at", LA).alias("PST_date")


def alert_repeat(orders: DataFrame, visitors: DataFrame, excluded: DataFrame, minutes: int = 30, more_than: int = 2) -> DataFrame:
    """Latest orders of visitors with several orders all of one amount, country not excluded."""
    latest = latest_orders(orders, minutes).where(F.length("visitor_id") > 5)
    flagged = order_groups(latest, "visitor_id").where((F.col("orders") > more_than) & (F.col("lo") == F.col("hi"))).select("visitor_id", "first_to_last")
    rows = _with_visitors(latest.join(flagged, "visitor_id"), visitors, excluded)
    return rows.select("visitor_id", _pst(), F.col("increment_id").alias("oid"), "user_pseudo_id", "country", "first_to_last").distinct()


def alert_amount(orders: DataFrame, visitors: DataFrame, excluded: DataFrame, minutes: int = 30, more_than: int = 2) -> DataFrame:
    """Latest orders of any amount that several orders share, country of the visitor not excluded."""
    latest = latest_orders(orders, minutes).where("revenue is not null")
    flagged = order_groups(latest.withColumn("amount", F.col("revenue")), "amount").where(F.col("orders") > more_than).select(F.col("amount").alias("revenue"), "first_to_last")
    rows = _with_visitors(latest.join(flagged, "revenue"), visitors, excluded)
    return rows.select("visitor_id", _pst(), F.col("increment_id").alias("oid"), "revenue", "user_pseudo_id", "country", "first_to_last").distinct()
