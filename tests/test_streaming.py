"""The hourly job as a stream gives the batch result."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from brightledger.operators.email import hourly_activity
from brightledger.streaming.alerts import alert_windows
from brightledger.streaming.hourly import hourly_activity_stream, hourly_report, upsert_hours


def test_stream_equals_batch(spark, tmp_path):
    acts = [(f"2024-01-01 {h:02d}:{m:02d}:00", "open" if m % 2 else "click") for h in range(6) for m in range(0, 60, 7)]
    sent = [(f"2024-01-01 {h:02d}:30:00",) for h in range(6)]
    late = [("2024-01-03 00:00:00", "open")]  # moves the watermark beyond all hours above
    offsets = spark.sql("select date'2024-01-01' as Date, -8 as UTC_2_PST, -5 as UTC_2_EST, 2 as UTC_2_ILS")
    a = spark.createDataFrame(acts, "time string, action string")
    s = spark.createDataFrame(sent, "time string")
    path = {}
    for name, df in (("a", a), ("s", s)):
        path[name] = str(tmp_path / name)
        df.coalesce(1).write.parquet(path[name])
    spark.createDataFrame(late, a.schema).coalesce(1).write.mode("append").parquet(path["a"])
    read = lambda n, df: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path[n])
    query = (hourly_activity_stream(read("a", a), read("s", s), offsets).writeStream.outputMode("append").format("memory")
             .queryName("hours").option("checkpointLocation", str(tmp_path / "cp")).start())
    query.processAllAvailable()
    query.stop()
    got = sorted(tuple(r) for r in spark.table("hours").collect())
    want = sorted(tuple(r) for r in hourly_activity(a, s, offsets).collect())
    assert got == want


def test_late_and_repeated_batches_correct_the_report(spark, tmp_path):
    """A row days behind the newest one changes its hour only, and a batch that runs twice changes nothing."""
    offsets = spark.sql("select date'2024-01-01' as Date, -8 as UTC_2_PST, -5 as UTC_2_EST, 2 as UTC_2_ILS")
    parts = [[(f"2024-01-01 {h:02d}:{m:02d}:00", "open" if m % 2 else "click") for h in range(4) for m in range(0, 60, 7)], [("2024-01-05 00:00:00", "open")], [("2024-01-01 02:59:59", "open"), ("2024-01-01 02:00:00", "late")]]
    schema = "time string, action string"
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    sent = spark.createDataFrame([("2024-01-01 03:30:00",)], "time string")
    sent.coalesce(1).write.parquet(str(tmp_path / "sent"))

    def run():
        read = spark.readStream.schema(schema).parquet(path)
        query = hourly_report(read, spark.readStream.schema(sent.schema).parquet(str(tmp_path / "sent")), offsets, out).option("checkpointLocation", str(tmp_path / "cp")).start()
        query.processAllAvailable()
        query.stop()

    for part in parts:
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("report/*/*.parquet")}
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        run()
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("report/*/*.parquet")}
    assert {f.parent.name for f in files if before.get(f) != files[f]} == {"hour=2024010102"}
    everything = spark.createDataFrame([r for part in parts for r in part], schema)
    want = sorted(map(tuple, hourly_activity(everything, sent, offsets).collect()), key=repr)
    report = lambda: sorted((tuple(r)[:-1] for r in spark.read.parquet(f"{out}/report").collect()), key=repr)
    assert report() == want
    last = spark.createDataFrame(parts[2], schema).select(F.col("time").cast("timestamp_ntz").alias("at"), F.col("action").alias("Type"))
    upsert_hours(last, 2, out, offsets)
    assert report() == want


def test_alert_stream_equals_batch(spark, tmp_path):
    rng, start = random.Random(5), datetime(2024, 1, 1)
    rows = [(f"o{i}", rng.choice(["v1", "v2", "v3", None]), float(rng.choice([10, 10, 20])), start + timedelta(minutes=i, seconds=rng.randrange(50))) for i in range(120)]
    rows = sorted([*rows, *[(o, v, a, t + timedelta(seconds=5)) for o, v, a, t in rows[::4]]], key=lambda r: r[3])
    schema = "increment_id string, visitor_id string, revenue double, created_at timestamp_ntz"
    path = str(tmp_path / "in")
    for part in (rows[:70], rows[70:], [("end", "x", 1.0, start + timedelta(days=2)), ("end2", "x", 1.0, start + timedelta(days=3))]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    stream = alert_windows(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), "visitor_id")
    query = stream.writeStream.outputMode("append").format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    got = sorted(map(tuple, spark.table("alerts").collect()))
    first = {}
    for o, v, a, t in rows:
        if v:
            first.setdefault(o, (v, a, t))
    want = []
    for i in range(-12, 60):
        lo = start + timedelta(minutes=5 * i)
        hi = lo + timedelta(minutes=30)
        for v in ("v1", "v2", "v3"):
            own = [(a, t) for w, a, t in first.values() if w == v and lo <= t < hi]
            if len(own) > 2 and len({a for a, _ in own}) == 1:
                minute = lambda t: int((t - start).total_seconds() // 60)
                want.append((lo, hi, v, len(own), own[0][0], own[0][0], minute(max(t for _, t in own)) - minute(min(t for _, t in own))))
    assert got == sorted(want) and got
    assert sorted(map(tuple, alert_windows(spark.createDataFrame(rows, schema), "visitor_id").collect())) == got
