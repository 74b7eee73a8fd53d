"""Skew-safe operators against brute force; one key holds a third of the rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brightledger.operators.feeds import order_rows, purchases_around
from brightledger.operators.ordered import earliest_within, last_before, neighbours, numbered, running, sweep

START = datetime(2024, 1, 1)


def moments(n, seed, span_minutes=4000):
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(4)}", START + timedelta(seconds=rng.randrange(span_minutes * 60)), i) for i in range(n)]


def minute(t):
    return int((t - datetime(1970, 1, 1)).total_seconds() // 60)


def frame(spark, rows, names="k string, ts timestamp_ntz, id long"):
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize("width", [7, 60, 480])
def test_earliest_within(spark, width):
    facts, probes = moments(300, 1), moments(200, 2)
    facts += [(k, t, 1000 + i) for k, t, i in probes[:40]]  # facts at the very moment of a probe
    facts += [(k, t + timedelta(seconds=1), 2000 + i) for k, t, i in probes[:40]]  # and just after it
    want = {}
    for k, t, i in probes:
        near = [(-fi, ft) for fk, ft, fi in facts if fk == k and ft <= t and 0 <= minute(t) - minute(ft) <= width]
        if near:
            want[i] = min(near)
    f = frame(spark, facts).select("k", F.col("ts").alias("since"), (-F.col("id")).alias("w"))
    got = earliest_within(frame(spark, probes), f, ["k"], "ts", "since", width, F.struct("w", "since"), "best")
    assert {r.id: tuple(r.best) for r in got.collect()} == want


@pytest.mark.parametrize("after", [False, True])
def test_last_before(spark, after):
    facts, probes = moments(200, 3), moments(150, 4)
    facts += [(k, t, 1000 + i) for k, t, i in probes[:30]]
    pick = min if after else max
    want = {}
    for k, t, i in probes:
        near = [(ft, fi) for fk, ft, fi in facts if fk == k and (ft > t if after else ft < t)]
        want[i] = pick(near)[1] if near else None
    f = frame(spark, facts).select("k", F.col("ts").alias("since"), F.col("id").alias("fid"))
    got = last_before(frame(spark, probes), f, ["k"], "ts", "since", ["fid"], ["fid"], after=after)
    assert {r.id: r.fid for r in got.collect()} == want


@pytest.mark.parametrize("most", [5, 1000])
def test_sweep(spark, most):
    """Both sides at once equal the two as-of lookups; ties at a moment go by the payload; nulls drop out."""
    facts, probes = moments(250, 8), moments(150, 9)
    facts += [(k, t, 1000 + i) for k, t, i in probes[:30]] + [(k, t, 2000 + i) for k, t, i in facts[:30]] + [(None, START, 1), ("hot", None, 2)]
    probes += [("alone", START, 5000), (None, START, 5001), ("hot", None, 5002)]
    want = {}
    for k, t, i in probes:
        if k is not None and t is not None:
            own = [(ft, fi) for fk, ft, fi in facts if fk == k and ft is not None]
            want[i] = (max((f for f in own if f[0] < t), default=None), min((f for f in own if f[0] > t), default=None), sum(f[0] == t for f in own))
    f = frame(spark, facts).select("k", F.col("ts").alias("since"), F.col("id").alias("fid"))
    got = sweep(frame(spark, probes), f, ["k"], "ts", "since", ["fid"], most)
    assert got.columns == ["k", "ts", "id", "before", "after", "same"]
    assert {r.id: (r.before and tuple(r.before), r.after and tuple(r.after), r.same) for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert most == 5 or plan.count("Exchange hashpartitioning(k") == 1  # all rows by key once


def test_numbered_neighbours_running(spark):
    rows = moments(400, 5)
    df = frame(spark, rows)
    day, order = F.to_date("ts"), [F.col("ts"), F.col("id")]
    nth = {r.id: r.n for r in numbered(df, ["k"], day, order, "n").collect()}
    near = {r.id: (r.b, r.a) for r in neighbours(df, ["k"], day, ["ts", "id"], F.col("id"), "b", "a").collect()}
    run = {r.id: (r.s, r.m) for r in running(df, ["k"], day, order, {"s": ("sum", F.col("id")), "m": ("max", F.col("id"))}).collect()}
    back = {r.id: r.m for r in running(df, ["k"], day, order, {"m": ("min", F.col("id"))}, backward=True, inclusive=False).collect()}
    for key in {k for k, _, _ in rows}:
        ids = [i for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])) if k == key]
        for p, i in enumerate(ids):
            assert nth[i] == p + 1
            assert near[i] == (ids[p - 1] if p else None, ids[p + 1] if p + 1 < len(ids) else None)
            assert run[i] == (sum(ids[: p + 1]), max(ids[: p + 1]))
            assert back[i] == min(ids[p + 1:], default=None)


def test_purchases_around_equals_range_join(spark):
    orders = [(k, t.replace(minute=0, second=0), i) for k, t, i in moments(120, 6, 60 * 24 * 40)]
    reviews = moments(150, 7, 60 * 24 * 60)
    reviews += [(k, t, 900 + i) for k, t, i in orders[:20]]
    want = set()
    for k, t, rid in reviews:
        line = sorted((ot, oi) for ok, ot, oi in orders if ok == k)
        for p, (ot, oi) in enumerate(line):
            lo = line[p - 1][0] if p else ot.replace(year=ot.year - 1)
            hi = line[p + 1][0] if p + 1 < len(line) else ot.replace(year=ot.year + 1)
            if lo <= t <= hi:
                want.add((rid, oi))
    o = frame(spark, orders, "k string, ts timestamp_ntz, Order_Number long")
    r = frame(spark, reviews, "k string, at timestamp_ntz, review_id long")
    assert {(x.review_id, x.Order_Number) for x in order_rows(purchases_around(r, o, ["k"]), o, ["k"]).collect()} == want
