"""Reloads and merges: null rules, idempotence, untouched rows."""

from datetime import date

from pyspark.sql import functions as F

from brightledger.operators.relational import latest_per_group, not_in, semi_in
from brightledger.sources import targets as T
from brightledger.sources.shards import read_shards, scan_ingested, scan_shards


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_not_in_null_rules(spark):
    left = table(spark, [(1,), (2,), (None,)], "x int")
    listed = table(spark, [(1,), (1,)], "v int")
    assert rows(not_in(left, F.col("x"), listed)) == [(2,)]
    assert rows(not_in(left, F.col("x"), listed.unionByName(table(spark, [(None,)], "v int")))) == []
    assert rows(not_in(left, F.col("x"), listed.where("false"))) == [(1,), (2,), (None,)]
    assert rows(semi_in(left, F.col("x"), listed)) == [(1,)]
    left.createOrReplaceTempView("l")
    for values in ("1", "1, null"):
        spark.sql(f"select explode(array({values})) v").createOrReplaceTempView("r")
        want = rows(spark.sql("select x from l where x not in (select v from r)"))
        assert rows(not_in(spark.table("l"), F.col("x"), spark.table("r"))) == want


def test_latest_per_group_keeps_ties_and_null_groups(spark):
    df = table(spark, [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n")], "k string, t int, v string")
    assert rows(latest_per_group(df, ["k"], "t")) == [("a", 2, "y"), ("a", 2, "z"), (None, 5, "n")]


def test_reloads(spark):
    old = table(spark, [(date(2024, 1, 1), "o"), (date(2024, 1, 5), "o"), (None, "o")], "d date, v string")
    new = table(spark, [(date(2024, 1, 5), "n"), (date(2024, 1, 6), "n")], "d date, v string")
    once = T.reload_window(old, new, "d", date(2024, 1, 5))
    want = rows(old.where("d is null or d < date'2024-01-05'").unionByName(new))
    assert rows(once) == want and rows(T.reload_window(once, new, "d", date(2024, 1, 5))) == want
    by_key = T.reload_key(old, new.limit(0), "d", date(2024, 1, 5))
    assert rows(by_key) == [(None, "o"), (date(2024, 1, 1), "o")]
    assert rows(T.overwrite(old, new.select("v", "d"))) == rows(new)


def test_appends(spark):
    target = table(spark, [(1, "a"), (2, "b")], "k int, v string")
    src = table(spark, [(2, "x"), (3, "c"), (3, "c")], "k int, v string")
    assert rows(T.append_newer(target, src, "k")) == [(1, "a"), (2, "b"), (3, "c"), (3, "c")]
    assert rows(T.append_newer(target.where("false"), src, "k")) == []
    assert rows(T.append_new(target, src, "k")) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(T.append_new(target.unionByName(table(spark, [(None, "z")], "k int, v string")), src, "k")) == [(1, "a"), (2, "b"), (None, "z")]
    ref = table(spark, [("s", None)], "a string, b string")
    more = table(spark, [("s", None), ("s", "c"), (None, "c")], "a string, b string")
    assert rows(T.append_new_nullsafe(ref, more, ["a"], ["b"])) == [("s", "c"), ("s", None), (None, "c")]
    assert rows(T.snapshot(ref, date(2024, 2, 1))) == [(date(2024, 1, 31), "s", None)]
    assert rows(T.nth_row(target, ["k"], 2)) == [(2, "b")]


def test_merge_variants(spark):
    t = table(spark, [(1, "a", 10), (2, "b", 20), (3, None, 30), (None, "n", 40)], "k int, v string, w int")
    s = table(spark, [(1, "A", 99), (2, "b", 99), (4, "d", 50), (None, "N", 60)], "k int, v string, w int")
    kept = [(3, None, 30)]
    insert = T.merge(t, s, ["k"])
    assert rows(insert) == sorted(rows(t) + [(4, "d", 50), (None, "N", 60)], key=repr)
    update = T.merge(t, s, [], nullsafe=["k"], update=["v"], update_when=F.col("t_v") != F.col("s_v"))
    assert rows(update) == sorted([(1, "A", 10), (2, "b", 20), (4, "d", 50), (None, "N", 40)] + kept, key=repr)
    assert rows(T.merge(update, s, [], nullsafe=["k"], update=["v"], update_when=F.col("t_v") != F.col("s_v"))) == rows(update)
    gone = T.merge(t, s, ["k"], update=["v"], update_when=F.col("t_v") != F.col("s_v"), delete_when=F.col("t_w") == 20)
    assert rows(gone) == sorted([(1, "A", 10), (4, "d", 50), (None, "n", 40), (None, "N", 60)] + kept, key=repr)
    assert rows(T.merge(t, s, [], lower=["v"], insert=False, update=["w"])) == sorted(
        [(1, "a", 99), (2, "b", 99), (3, None, 30), (None, "n", 60)], key=repr)


def test_publish_and_shards(spark, tmp_path):
    df = table(spark, [("20240101", 1), ("20240102", 2), ("20240103", 3), ("intraday_20240103", 4), ("intraday_20240105", 5)], "shard string, x int")
    path = str(tmp_path / "t")
    T.publish(spark, df, path, "1")
    T.publish(spark, T.current(spark, path).where("x < 3"), path, "2")
    assert rows(T.current(spark, path).select("x")) == [(1,), (2,)]
    T.publish(spark, T.current(spark, path).where("x < 2"), path, "2")
    assert rows(T.current(spark, path).select("x")) == [(1,)]
    flat = str(tmp_path / "s")
    df.write.partitionBy("shard").parquet(flat)
    got = read_shards(spark, flat, date(2024, 1, 2), date(2024, 1, 3))
    assert rows(got.select("x")) == [(2,), (3,), (4,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "shard" in plan.split("PartitionFilters:")[1][:200]
    assert rows(scan_shards(df, date(2024, 1, 3)).select("x")) == [(3,), (4,), (5,)]
    stamped = spark.sql("select timestamp_ntz'2024-01-02 00:00:00' as ingest_ts union all select timestamp_ntz'2024-01-01 23:00:00'")
    assert scan_ingested(stamped, date(2024, 1, 2)).count() == 1


def test_append_reads_the_published_mark(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.sql("select id as x, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id) as ts from range(5)")
    T.publish(spark, old, path, "1", marks=["x", "ts"])
    src = spark.sql("select id as x, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id) as ts from range(3, 9)")
    newer = T.newer_than_published(spark, path, src, "ts")
    assert path not in newer._jdf.queryExecution().executedPlan().toString() and not newer.inputFiles()
    T.publish_newer(spark, path, src, "ts", "2")
    want = rows(T.append_newer(old, src, "ts"))
    assert rows(T.current(spark, path)) == want
    T.publish_newer(spark, path, src, "ts", "2")  # again: nothing is newer
    assert rows(T.current(spark, path)) == want
    T.publish(spark, old.where("false"), path, "3", marks=["ts"])
    assert T.newer_than_published(spark, path, src, "ts").count() == 0


def test_stage_reads_back_the_same_rows(spark):
    df = spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' as t", "if(id > 5, null, 'x') as s")
    back = T.stage(df)
    assert back.schema == df.schema or back.dtypes == df.dtypes
    assert rows(back) == rows(df)


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "d")
    T.replace_partitions(table(spark, [("a", 1), ("b", 2)], "day string, x int"), path, ["day"])
    T.replace_partitions(table(spark, [("b", 3), ("c", 4)], "day string, x int"), path, ["day"])
    assert rows(spark.read.parquet(path).select("day", "x")) == [("a", 1), ("b", 3), ("c", 4)]


def test_merge_deletes_only_where_it_neither_updates_nor_is_foreign(spark):
    target = table(spark, [(1, "old"), (2, "same"), (3, "gone"), (None, "null")], "k int, v string")
    src = table(spark, [(1, "new"), (3, "x"), (4, "fresh"), (None, "n")], "k int, v string")
    out = T.merge(target, src, ["k"], update=["v"], update_when=F.col("t_k") == 1, delete_when=F.col("s_v") == "x")
    assert sorted(map(str, rows(out.select("k", "v")))) == sorted(map(str, [(1, "new"), (2, "same"), (None, "null"), (4, "fresh"), (None, "n")]))


def test_staging_asks_for_a_shared_folder(spark):
    assert T.shared_folder(spark)


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_merge_by_partition_leaves_others_alone(spark, tmp_path):
    path = tmp_path / "t"
    old = table(spark, [(d, k, "o") for d in range(1, 7) for k in ("a", "b")], "d int, k string, v string")
    old.coalesce(1).write.partitionBy("d").parquet(str(path))
    before = files(path)
    src = table(spark, [(2, "a", "n"), (2, "c", "n"), (9, "a", "n")], "d int, k string, v string")
    assert T.merge_partitions(spark, str(path), src, ["d", "k"], "d", update=["v"]) == [2, 9]
    want = rows(T.merge(old, src, ["d", "k"], update=["v"]))
    assert rows(spark.read.parquet(str(path)).select("d", "k", "v")) == want
    after = files(path)
    assert {f for f in before if after.get(f) == before[f]} == {f for f in before if not f.startswith("d=2/")}
    # again: the same content
    T.merge_partitions(spark, str(path), src, ["d", "k"], "d", update=["v"])
    assert rows(spark.read.parquet(str(path)).select("d", "k", "v")) == want


def test_merge_finds_rows_in_other_partitions_and_empties_them(spark, tmp_path):
    path = tmp_path / "t"
    old = table(spark, [(1, "a", "o"), (2, "b", "o"), (2, None, "o"), (3, "c", "o"), (None, "d", "o")], "d int, k string, v string")
    old.coalesce(1).write.partitionBy("d").parquet(str(path))
    src = table(spark, [(5, "A", "gone"), (5, "D", "gone"), (5, "x", "new")], "d int, k string, v string")
    how = {"lower": ["k"], "update": ["v"], "update_when": F.lit(False), "delete_when": F.col("s_v") == "gone"}
    assert T.merge_partitions(spark, str(path), src, [], "d", **how) == [1, 5, None]
    want = [(2, "b", "o"), (2, None, "o"), (3, "c", "o"), (5, "x", "new")]
    assert rows(spark.read.parquet(str(path)).select("d", "k", "v")) == sorted(want, key=repr) == rows(T.merge(old, src, [], **how))
    assert T.merge_partitions(spark, str(path), src.where("false"), [], "d", **how) == []


def test_merge_reads_the_partitions_it_needs(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id % 10 AS d", "id AS k").write.partitionBy("d").parquet(path)
    held = T.within(spark.read.parquet(path), "d", [3, 4])
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [d" in plan and held.count() == 20
    assert {f.split("/")[-2] for f in held.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"d=3", "d=4"}


def test_reload_by_partition(spark, tmp_path):
    import pytest

    path = tmp_path / "t"
    old = table(spark, [(date(2024, 1, d), "o") for d in range(1, 6)], "d date, v string")
    old.coalesce(1).write.partitionBy("d").parquet(str(path))
    before = files(path)
    new = table(spark, [(date(2024, 1, 3), "n"), (date(2024, 1, 5), "n"), (date(2024, 1, 9), "n")], "d date, v string")
    assert T.reload_partitions(spark, str(path), new, "d", date(2024, 1, 3)) == [date(2024, 1, d) for d in (3, 4, 5, 9)]
    want = rows(T.reload_window(old, new, "d", date(2024, 1, 3)))
    assert rows(spark.read.parquet(str(path)).select("d", "v")) == want
    after = files(path)
    assert all(after[f] == t for f, t in before.items() if f < "d=2024-01-03")
    with pytest.raises(ValueError, match="cutoff"):
        T.reload_partitions(spark, str(path), new, "d", date(2024, 1, 4))


def test_merge_leads_drops_nameless_rows_that_come_again(spark):
    from brightledger.operators.partners import merge_leads

    old = table(spark, [(1, None, "x"), (2, None, "x"), (3, "Ch", "x"), (4, "Other", "x")], "subscriber_id int, Name string, subscriber_email string")
    new = table(spark, [(1, "ch", "m1"), (2, None, "m2"), (3, "CH", "m3"), (4, "ch", "m4")], "subscriber_id int, Name string, subscriber_email string")
    assert rows(merge_leads(old, new, "Name")) == sorted([(1, "ch", "m1"), (2, None, "x"), (2, None, "m2"), (3, "Ch", "m3"), (4, "Other", "x"), (4, "ch", "m4")], key=repr)


def test_interval_join_by_blocks(spark):
    """Against comparing all pairs, with periods of one day and of fifty years; a period has at most two blocks per size."""
    import random
    from datetime import timedelta

    from brightledger.operators.relational import interval_cells, join_intervals

    rng, start = random.Random(3), date(1990, 1, 1)
    spans = [(rng.choice("ab"), start + timedelta(rng.randrange(9000)), rng.choice([0, 1, 6, 30, 365, 18_262]), i) for i in range(60)]
    spans = [(k, a, a + timedelta(n), i) for k, a, n, i in spans] + [("a", start, None, 100), ("b", start, start - timedelta(1), 101), ("a", start, date(9999, 12, 31), 102), (None, start, start, 103)]
    days = [(rng.choice("abc"), start + timedelta(rng.randrange(-400, 30_000))) for _ in range(150)] + [("a", None), (None, start), ("a", date(9999, 12, 31))]
    periods = table(spark, spans, "k string, lo date, hi date, i int")
    got = join_intervals(table(spark, days, "k string, d date").distinct(), periods, ["k"], "d", "lo", "hi")
    want = {(k, d, i) for k, d in days if k and d for pk, a, b, i in spans if pk == k and b and a <= d <= b}
    assert sorted((r.k, r.d, r.i) for r in got.collect()) == sorted(want)
    cells = periods.where("hi >= lo").select(F.datediff("hi", "lo").alias("n"), interval_cells(F.col("lo"), F.col("hi"), 23).alias("c")).collect()
    for r in cells:
        assert sum(1 << c.level for c in r.c) == r.n + 1 and len(r.c) <= 2 * (r.n + 1).bit_length()


def test_interval_blocks_are_not_broadcast(spark):
    """Spark takes the blocks of a period for no larger than the period, so the join must not leave the choice to its estimate."""
    from brightledger.operators.relational import join_intervals

    periods = spark.sql("SELECT k, date'2020-01-01' AS lo, date'2022-01-01' AS hi FROM VALUES ('a'), ('b') AS t(k)")
    got = join_intervals(spark.sql("SELECT 'a' AS k, date'2021-05-05' AS d"), periods, ["k"], "d", "lo", "hi")
    joins = [x for x in got._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join [" in x and "block" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    assert [tuple(r) for r in got.collect()] == [("a", date(2021, 5, 5), date(2020, 1, 1), date(2022, 1, 1))]
