"""Set-based rewrites against their literal form, on the supplied tables and on skewed rows."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from brightledger.operators import paths as P
from brightledger.operators import web as W
from brightledger.operators.reports import flag_report
from brightledger.sources import adapters as A
from brightledger.sources.shards import HIT_COLUMNS, flatten_hits

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def hits(spark):
    return A.staged_hits(spark, SF)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_flag_report_equals_distinct_counts(hits):
    atc = W.added_to_cart()
    got = flag_report(hits, ["deviceCategory"], {"Users": F.lit(True), "ATC": atc}, {"Visits": F.lit(True), "V_ATC": atc},
                      {"Revenue": F.coalesce(F.col("transactionRevenue"), F.lit(0))}, "Orders")
    session = F.struct("fullVisitorId", "visitId")
    want = hits.groupBy("deviceCategory").agg(
        F.count_distinct("fullVisitorId").alias("Users"), F.count_distinct(F.when(atc, F.col("fullVisitorId"))).alias("ATC"),
        F.count_distinct(session).alias("Visits"), F.count_distinct(F.when(atc, session)).alias("V_ATC"),
        F.sum(F.coalesce("transactionRevenue", F.lit(0))).alias("Revenue"), F.count_distinct("transactionId").alias("Orders"))
    assert rows(got) == rows(want)


def test_reset_fold_equals_day_loop(spark, hits):
    visits = hits.select("fullVisitorId", W.local_day("visitStartTime", W.LA).alias("d")).distinct().collect()
    want, last = set(), {}
    start = min(v.d for v in visits)
    for step in range((max(v.d for v in visits) - start).days + 1):
        day = start + timedelta(days=step)
        for v in visits:
            if v.d == day and (v.fullVisitorId not in last or (day - last[v.fullVisitorId]).days >= 7):
                want.add((v.fullVisitorId, day))
                last[v.fullVisitorId] = day
    got = P.reset_cohort(hits, 7).select("base_visitorId", "base_date").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_nested_rows_flatten_to_the_same_hits(spark, hits):
    assert rows(flatten_hits(A.sessions(spark, SF)).select(*HIT_COLUMNS)) == rows(hits.select(*HIT_COLUMNS))


def test_media_join_keeps_row_count(spark, hits):
    twice = A.media_reference(spark, SF).unionByName(A.media_reference(spark, SF))
    assert W.with_media(hits, twice, A.media_type(spark, SF)).count() == hits.count()


def skewed(spark):
    """One visitor with a third of all hits, cart views around orders at the 60 minute edge."""
    out, n = [], 0
    for visitor in ["hot"] * 3 + ["a", "b", "c", "d", "e", "f"]:
        for visit in range(1, 5):
            n += 1
            start = 1704067200 + (visit * 100 + n % 7) * 1800
            for hit in range(1, 9):
                kind = (hit * 7 + n * 3 + visit) % 5
                out.append((visitor, visit + 4 * (n % 3 if visitor == "hot" else 0), start, hit, hit * 1_800_000 + (n % 3) * 1000,
                            f"t{n}_{hit}" if kind == 0 else None, kind in (1, 2)))
    schema = "fullVisitorId string, visitNumber long, visitStartTime long, hitNumber long, time long, transactionId string, cart boolean"
    return spark.createDataFrame(out, schema)


def test_carts_with_orders_equals_pair_join(spark):
    hits = skewed(spark).dropDuplicates(["fullVisitorId", "visitNumber", "hitNumber"])
    # visits of a visitor must follow each other in time
    base = F.lit(1704067200) + F.col("visitNumber") * 18000
    hits = hits.withColumn("visitStartTime", base)
    carts = hits.where("cart")
    got = P.carts_with_orders(carts, hits, 60)
    hits.createOrReplaceTempView("h")
    minute = "floor((visitStartTime * 1000 + time) / 60000)"
    want = spark.sql(f"""with tr as (select distinct fullVisitorId f, visitNumber v, transactionId t, {minute} m from h where transactionId is not null)
        select fullVisitorId, visitNumber, t as transactionId, max(hitNumber) as hitNumber from h left join tr
          on fullVisitorId = f and visitNumber <= v and m - {minute} <= 60 where cart group by all""")
    assert rows(got) == rows(want)
    assert got.where("transactionId is null").count() and got.where("transactionId is not null").count()


def test_hot_visitor_in_first_touch(spark, hits):
    hot = hits.withColumn("fullVisitorId", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("fullVisitorId")))
    ref = A.media_reference(spark, SF)
    got = W.first_touch(hot, ref, "UTC")
    firsts = hot.groupBy(W.local_day("visitStartTime", "UTC").alias("Date"), "fullVisitorId").agg(F.min("visitNumber").alias("visitNumber"))
    want = W.with_media(hot.withColumn("Date", W.local_day("visitStartTime", "UTC")).join(firsts, ["Date", "fullVisitorId", "visitNumber"]), ref)
    assert rows(got) == rows(want.select("Date", "fullVisitorId", "Media").distinct())
    assert date(2024, 1, 1) <= got.agg(F.min("Date")).first()[0]


def test_banner_counts_do_not_depend_on_the_number_of_orders(spark):
    base = dict(fullVisitorId="v", visitNumber=1, visitStartTime=1704067200, deviceCategory="d", country="c", region="r", source="s", medium="m", campaign=None, customerId=None,
                pagePath="/a", totalHits=7, time=5000, eventLabel="L", eventAction=None, transactionId=None, transactionRevenue=None)
    hits = [base | dict(eventAction="HP Banner Impression"), base | dict(eventAction="hp banner impression", time=9000),
            base | dict(transactionId="t1", transactionRevenue=2_000_000), base | dict(transactionId="t2", transactionRevenue=3_000_000)]
    schema = ("fullVisitorId string, visitNumber long, visitStartTime long, deviceCategory string, country string, region string, source string, medium string, campaign string, "
              "customerId long, pagePath string, totalHits long, time long, eventLabel string, eventAction string, transactionId string, transactionRevenue long")
    ref = spark.createDataFrame([("s", "m", None, None, "M")], "source string, medium string, campaign string, adwords_account long, Media string")
    row = W.banner_report(spark.createDataFrame([tuple(h[c.split()[0]] for c in schema.split(", ")) for h in hits], schema), ref).first()
    assert (row["imp"], row["hits"], row["Unique_Events"], row["transactions"], row["transactionRevenue"]) == (2, 14, 1, 2, 5.0)


def test_years_and_colours_are_not_cut(spark):
    from brightledger.operators.email import delivery_date
    from brightledger.operators.feeds import base_name

    names = spark.createDataFrame([("1.2.24_a",), ("1.2.2024_b",), ("1.2.202_c",), ("1.2.20245_d",), ("1.2.4_e",)], "MessageName string")
    got = {r[0][-1]: r[1] for r in delivery_date(names).collect()}
    assert got == {"a": date(2024, 2, 1), "b": date(2024, 2, 1), "c": None, "d": None, "e": None}
    item = spark.createDataFrame([("Frame One Two Three Four Five Six Kids", "One Two Three Four Five Six")], "n string, c string")
    assert item.select(base_name(F.col("n"), F.col("c"), {})).first()[0].split() == ["Frame", "Kids"]
