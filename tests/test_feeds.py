"""The review feed on rows of its own: repeated rows, missing parts, and how wide rows travel."""

import random
from datetime import datetime, timedelta

import pytest

from brightledger.operators import feeds


def ts(day, hour=12):
    return datetime(2024, 1, day, hour)


def inputs(spark):
    reviews = [(i, f"N{i}", a, ts(d), "T", "Text", 5, True, 2, 1, 3, s, p) for i, a, d, s, p in
               [(1, 1, 5, 1, 10), (1, 1, 5, 1, 10), (2, 1, 9, 1, 11), (3, 2, 5, 1, 10), (4, 9, 5, 1, 99), (5, 1, 5, 2, 10), (6, 3, 5, 1, 10)]]
    make = spark.createDataFrame
    return dict(
        reviews=make(reviews, "id long, nickname string, author_id long, created_at timestamp_ntz, title string, detail string, overall int, recommend boolean, fit int, style int, quality int, status_id int, product_id long"),
        authors=make([(1, "A@x"), (1, "a@X"), (2, None), (3, "c@x")], "id long, email string"),
        inventory=make([(10, "s10", "P10", "B"), (11, "s11", "P11", "B")], "product_id long, sku string, name string, brand string"),
        gtins=make([("s10", "g1"), ("s10", "g2"), ("s10", "g2")], "sku string, UPC string"),
        mpns=make([("s11", "m")], "id string, MPN string"),
        stock=make([("s10", "u10"), ("s11", "u11")], "sku string, url_key string"),
        items=make([("a@x", "s10", ts(4), 100), ("a@x", "s10", ts(6), 101), ("a@x", "s99", ts(8), 102), ("a@x", "s10", ts(5), 103), ("z@x", "s10", ts(5), 104)],
                   "customer_email string, FinalShortSKU string, Creation_Datetime timestamp_ntz, Order_Number long"))


def test_review_feed_rows(spark):
    out = feeds.review_feed(**inputs(spark), site="https://s/", zone="UTC")
    rows = sorted(((r["review_id"], r["sku"], r["gtin"], r["mpn"], r["product_url"], r["transaction_id"]) for r in out.collect()), key=repr)
    url = "https://s/u1{}.html"
    want = [(1, "s10", g, None, url.format(0), o) for g in ("g1", "g2") for o in (100, 101, 103)]
    want += [(2, "s11", None, "m", url.format(1), 102)]  # no order follows: the customer's last one, less than a year ago
    want += [(i, "s10", g, None, url.format(0), None) for i in (3, 6) for g in ("g1", "g2")] + [(4, None, None, None, None, None)]
    assert rows == sorted(want, key=repr)


@pytest.fixture
def shuffled(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, held)


def test_last_distinct_has_no_shuffle_of_wide_rows(spark, shuffled):
    plan = feeds.review_feed(**inputs(spark), site="https://s/", zone="UTC")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Join")[0]  # the last distinct stays where the join left the rows


def test_texts_are_shuffled_once(spark, shuffled):
    plan = feeds.review_feed(**inputs(spark), site="https://s/", zone="UTC")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = [node for node in plan.split("\n\n") if ") Exchange" in node.split("\n")[0] and "detail#" in node]
    assert len(moved) == 1  # to their review_id, not to their product before


def around(facts, at):
    """The orders whose span holds a moment: those at it, the last one before it and the first one after it. A null number ranks lowest."""
    rank = [(t, o is not None, o or 0) for t, o in facts]
    before, after, same = max((r for r in rank if r[0] < at), default=None), min((r for r in rank if r[0] > at), default=None), [o for t, o in facts if t == at]
    earlier = before[2] if before and before[1] and (after or same or before[0].replace(year=before[0].year + 1) >= at) else None
    later = after[2] if after and after[1] and (before or same or after[0].replace(year=after[0].year - 1) <= at) else None
    return (earlier, later, sorted(set(same), key=repr)) if same or earlier is not None or later is not None else None


@pytest.mark.parametrize("most", [30, 1_000_000])
def test_orders_around(spark, most):
    """Customers in one task and customers split by day give the orders that comparing all pairs gives."""
    rng = random.Random(4)
    day = lambda: datetime(2020, 1, 1) + timedelta(days=rng.choice([rng.randrange(40), rng.randrange(1500)]))
    who, what = lambda: rng.choice(["a", "a", "a", "b", "c", "d", f"e{rng.randrange(9)}"]), lambda: rng.choice(["s1", "s2", "s3", "", f"t{rng.randrange(9)}"])
    bought = [(who(), day(), rng.choice([None, *range(1, 200)]), sorted({what() for _ in range(rng.randrange(4))})) for _ in range(150)]
    bought = list({x[:3]: x for x in bought + [("nobody", day(), n, ["s1"]) for n in range(40)]}.values())
    asked = [(n, who(), rng.choice([what(), None]), rng.choice([day(), rng.choice(bought)[1]])) for n in range(120)]
    want = {}
    for n, e, s, at in asked:
        own = around([(t, o) for b, t, o, skus in bought if b == e and s in skus], at) if s is not None else None
        rest = around([(t, o) for b, t, o, _ in bought if b == e], at)
        if own or rest:
            want[n] = (at, e, own is not None, s if own else "", *(own or rest))
    found = feeds.orders_around(spark.createDataFrame(asked + asked[:20], "review_id long, e string, sku string, at timestamp_ntz"),
                                spark.createDataFrame(bought, "e string, ts timestamp_ntz, Order_Number long, skus array<string>"), most)
    got = {(r.review_id, r.at, r.e, r.own_item, r.s, r.earlier, r.later, tuple(sorted({x.Order_Number for x in r.at_once or []}, key=repr))) for r in found.collect()}
    best = {}
    for n, at, *row in sorted(got, key=repr):  # customers split by day give both levels
        best[n] = max(best.get(n, (at, *row)), (at, *row), key=lambda x: x[2])
    assert {n: (*x[:-1], list(x[-1])) for n, x in best.items()} == want
    assert len(got) > len(best) if most == 30 else len(got) == len(best)


def test_repeated_and_missing_ids(spark):
    """A repeated review takes the best orders at its own moment; one without an id takes its product, but no order."""
    given = inputs(spark)
    row = lambda i, a, d, p: (i, f"N{i}", a, d if d is None else ts(d), "T", "Text", 5, True, 2, 1, 3, 1, p)
    given["reviews"] = spark.createDataFrame([row(1, 1, 5, 10), row(1, 4, 5, 11), row(1, 1, 9, 11), row(1, 1, None, 10), row(None, 1, 5, 10), row(None, 1, 5, 11), row(None, 1, 5, None), row(0, 4, 5, 11)], given["reviews"].schema)
    given["authors"] = spark.createDataFrame([(1, "A@x"), (4, "z@x")], "id long, email string")
    out = feeds.review_feed(**given, site="https://s/", zone="UTC")
    got = {(r["review_id"], r["reviewer_id"], r["review_timestamp"] and r["review_timestamp"][8:10], r["sku"], r["transaction_id"]) for r in out.collect()}
    want = {(1, 1, "05", "s10", o) for o in (100, 101, 103)} | {(1, 4, "05", "s11", o) for o in (100, 101, 103)}
    want |= {(1, 1, "09", "s11", 102), (1, 1, None, "s10", None), (None, 1, "05", "s10", None), (None, 1, "05", "s11", None), (None, 1, "05", None, None), (0, 4, "05", "s11", 104)}
    assert got == want


@pytest.mark.parametrize("many", [0, 10])
def test_keys_of_repeated_reviews_stay(spark, many):
    found = spark.createDataFrame([(1, ts(1), "a", "s", 7), (2, ts(2), "b", "t", 8), (2, ts(3), "c", "u", 9)], "review_id long, at timestamp_ntz, e string, s string, earlier long")
    ids = spark.createDataFrame([(1,), (2,), (2,), (3,)], "rid long")
    got = sorted(tuple(r) for r in feeds._unkeyed(found, ids, many).collect())
    assert got == [(1, ts(1), "a", "s", 7) if many == 0 else (1, None, None, None, 7), (2, ts(2), "b", "t", 8), (2, ts(3), "c", "u", 9)]
