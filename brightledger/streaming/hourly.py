"""Hourly activity over a stream of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.columns import from_micros
from ..operators.email import as_datetime, with_offset
from ..sources.targets import replace_partitions, stage, within

ZONES = {"UTC_2_PST": "Datetime_PST", "UTC_2_EST": "Datetime_EST", "UTC_2_ILS": "Datetime_ILS"}


def _events(activity: DataFrame, sent: DataFrame) -> DataFrame:
    both = activity.select(as_datetime("time").alias("at"), F.col("action").alias("Type")).unionByName(
        sent.select(as_datetime("time").alias("at"), F.lit("Message_Sent").alias("Type")))
    return both.where("at is not null")


def hourly_activity_stream(activity: DataFrame, sent: DataFrame, offsets: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Events per hour and type, each hour emitted once it is ``lateness`` behind the newest event.

    Same columns as the batch job. The inputs are streams (a batch works as well); the offset
    table is static and joined after the counts.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("at"))
    timed = _events(activity, sent).select(F.timestamp_micros(micros).alias("ts"), "Type")
    counts = (timed.withWatermark("ts", lateness).groupBy(F.window("ts", "1 hour").alias("w"), "Type")
              .agg(F.count(F.lit(1)).alias("Amount")))
    hours = counts.select(from_micros(F.unix_micros(F.col("w.start"))).alias("DateTime"), "Type", "Amount")
    return with_offset(hours, "DateTime", offsets, ZONES).select("DateTime", "Type", *ZONES.values(), "Amount")


def upsert_hours(batch: DataFrame, batch_id: int, path: str, offsets: DataFrame) -> None:
    """Bring a report of hours up to date with one micro-batch of events (at, Type), however late they are.

    The batch's counts go to a partition of their own per hour and batch, so a batch that is run again replaces what it wrote
    before. The report's partitions of the hours that the batch touches are then summed up anew; all other hours stay as they are.
    """
    spark = batch.sparkSession
    hour = F.date_trunc("hour", "at").cast("timestamp_ntz")
    counts = batch.groupBy(hour.alias("DateTime"), "Type").agg(F.count(F.lit(1)).alias("Amount"))
    counts = stage(counts.select("*", F.date_format("DateTime", "yyyyMMddHH").alias("hour"), F.lit(batch_id).alias("batch")))
    replace_partitions(counts, f"{path}/counts", ["hour", "batch"])
    touched = [r["hour"] for r in counts.select("hour").distinct().collect()]  # hours, not events
    if not touched:
        return
    schema = counts.select("DateTime", "Type", "Amount", "hour", "batch").schema
    held = within(spark.read.schema(schema).parquet(f"{path}/counts"), "hour", touched)
    sums = held.groupBy("DateTime", "Type", "hour").agg(F.sum("Amount").alias("Amount"))
    report = with_offset(sums, "DateTime", offsets, ZONES).select("DateTime", "Type", *ZONES.values(), "Amount", "hour")
    replace_partitions(stage(report), f"{path}/report", ["hour"])


def hourly_report(activity: DataFrame, sent: DataFrame, offsets: DataFrame, path: str) -> DataStreamWriter:
    """A writer that keeps ``path``/report equal to the batch job over all events so far, late ones included. No state is held between batches."""
    return _events(activity, sent).writeStream.foreachBatch(lambda batch, i: upsert_hours(batch, i, path, offsets))
