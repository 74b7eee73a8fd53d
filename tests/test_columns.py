"""Helpers with fixed semantics on rows that trip naive versions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from brightledger.functions import columns as C
from brightledger.functions.channels import channel
from brightledger.functions.rules import path_type
from brightledger.operators.email import delivery_date
from brightledger.operators.feeds import base_name, number_text
from brightledger.operators.partners import dotted_date, fee_type


def one(spark, *cols, sql="select 1 as x"):
    return tuple(spark.sql(sql).select(*cols).first())


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_boundaries_are_counted_not_whole_units(spark):
    a, b = ts("2024-01-01 10:00:59"), ts("2024-01-01 10:01:00")
    assert one(spark, C.diff_boundary("MINUTE", b, a), C.diff_boundary("HOUR", b, a), C.diff_boundary("MINUTE", a, b)) == (1, 0, -1)
    assert one(spark, C.diff_boundary("DAY", ts("2024-01-02 00:00:00"), ts("2024-01-01 23:59:59"))) == (1,)
    assert one(spark, C.diff_boundary("MINUTE", ts("1969-12-31 23:59:59"), ts("1969-12-31 23:58:00"))) == (1,)


def test_zone_conversion_knows_daylight_saving(spark):
    got = one(spark, C.to_zone(ts("2024-01-05 03:00:00"), "America/Los_Angeles"), C.to_zone(ts("2024-07-05 03:00:00"), "America/Los_Angeles"),
              C.local_day(F.lit(1704423600), "America/Los_Angeles"))
    assert got == (datetime(2024, 1, 4, 19), datetime(2024, 7, 4, 20), date(2024, 1, 4))
    assert one(spark, C.iso_with_offset(ts("2024-01-05 03:00:07"), "America/New_York")) == ("2024-01-05T03:00:07-05:00",)


def test_seconds_and_micros(spark):
    assert one(spark, C.from_seconds(F.lit(1704067200)), C.epoch_micros(ts("2024-01-01 00:00:00.5"))) == (
        datetime(2024, 1, 1), 1704067200500000)


def test_paths(spark):
    assert one(spark, C.path_only(F.lit("/a/b?x=1?y")), C.path_only(F.lit("/a")), C.path_only(F.lit("?q")),
               C.path_only(F.lit(None).cast("string"))) == ("/a/b", "/a", "", None)
    rules = [("/p/", "P"), ("/", "Root")]
    assert one(spark, path_type(F.lit("/p/1"), rules), path_type(F.lit("/x"), rules), path_type(F.lit("x"), rules)) == ("P", "Root", "Other")


def test_items_and_text(spark):
    parts = C.split_literal(F.lit("1.2.3"), ".")
    assert one(spark, C.item(parts, 0), C.item(parts, 3), F.size(parts)) == ("1", None, 3)
    assert one(spark, C.money_text(F.lit("$1,234.50")), C.money_text(F.lit("tbd"))) == (1234.5, None)
    assert one(spark, *[C.bucket_ladder(F.lit(n)) for n in (0, 1, 2, 3)]) == ("0", "1", "2", ">2")
    assert one(spark, number_text(F.lit(12.0)), number_text(F.lit(12.5)), number_text(F.lit(12.345))) == ("12", "12.5", "12.35")


def test_bad_dates_give_null(spark):
    assert one(spark, dotted_date(F.lit("5.3.21")), dotted_date(F.lit("5.3.95")), dotted_date(F.lit("31.2.21")), dotted_date(F.lit("soon"))) == (
        date(2021, 3, 5), date(1995, 3, 5), None, None)
    rows = [("16.8.20_a",), ("16.8.2021_b",), ("1.13.20_c",), ("Welcome",), ("1.1.20_test",), (None,), ("7",)]
    got = {r.MessageName: r.DDate for r in delivery_date(spark.createDataFrame(rows, "MessageName string")).collect()}
    assert got == {"16.8.20_a": date(2020, 8, 16), "16.8.2021_b": date(2021, 8, 16), "1.13.20_c": None, "7": None}


def test_fee_text(spark):
    texts = ["Flat + RevSh", "comm only", "revsh", "flat", "?", None]
    assert one(spark, *[fee_type(F.lit(t).cast("string")) for t in texts]) == (
        "Flat + Commission", "Commission Only", "Commission Only", "Flat", "check", "check")


def test_base_name(spark):
    assert one(spark, base_name(F.lit("Otto Red w/ Blue"), F.lit("Red , Blue"), {}), base_name(F.lit("A"), F.lit("a b c d e f"), {})) == ("Otto", "A")


def test_channel_rules_first_match_and_nulls(spark):
    rows = [("google", "cpc", "au pla x", None), ("google", "organic", None, None), ("google", "cpc", "my yt", 9), ("bing", "organic", None, None),
            ("facebook", None, None, None), ("facebook", "x", None, None), ("instagram", None, "a", None), ("instagram", "joe", "a", None),
            ("tiktok", "shop-1", "a", None), ("sms", "cart_abandonment", "Contact", None), ("", None, None, None), ("cri", "NAQ", None, None)]
    df = spark.createDataFrame(rows, "source string, medium string, campaign string, account long")
    col = channel(F.col("source"), F.col("medium"), F.col("campaign"), F.col("account"), F.lit(None).cast("string"), brand="acme", shop="acm",
                  accounts={"remarketing": 9})
    assert [r[0] for r in df.select(col).collect()] == [
        "Google PLA AU", "Google Organic", "Youtube", "Bing Organic", "Facebook NAQ", "Facebook Brand", "Instagram", "Influencers",
        "Tiktok", "SMS Contacts Abn", "Other", "Criteo NAQ"]


def test_offset_minutes_and_quarters(spark):
    assert one(spark, C.iso_with_offset(ts("2024-01-05 03:00:07"), "Asia/Kolkata")) == ("2024-01-05T03:00:07+05:30",)
    assert one(spark, C.iso_with_offset(ts("2024-07-05 03:00:07"), "America/St_Johns")) == ("2024-07-05T03:00:07-02:30",)


def test_one_row_for_each_channel_rule(spark):
    """A row made from each rule's own patterns gets the label of the first rule that holds for it."""
    import re

    from brightledger.functions.channels import RULES

    words = {"{brand}": "acme", "{shop}": "acm", "{own}": "shop"}
    names = sorted({a for _, tests in RULES for a in tests.get("account", [])})
    accounts = {a: i + 1 for i, a in enumerate(names)}

    def text(pattern):
        for k, v in words.items():
            pattern = pattern.replace(k, v)
        return pattern

    def like(value, pattern):
        if value is None:
            return False
        value = value.lower() if pattern.startswith("~") else value
        parts = re.findall(r"\\.|.", text(pattern.lstrip("~")))  # a backslash takes the next letter as it is
        return re.fullmatch("".join(".*" if c == "%" else "." if c == "_" else re.escape(c[-1]) for c in parts), value, re.S) is not None

    def holds(row, tests):
        for test, patterns in tests.items():
            if test == "account":
                ok = row["account"] in [accounts[a] for a in patterns]
            elif test == "campaign":
                ok = all(like(row["campaign"], p) for p in patterns)
            elif test.startswith("not_"):
                ok = row[test[4:]] is not None and not any(like(row[test[4:]], p) for p in patterns)
            else:
                ok = any(like(row[test], p) for p in patterns)
            if not ok:
                return False
        return True

    rows = []
    for _, tests in RULES:
        row = {"source": None, "medium": None, "campaign": None, "account": None, "category": None}
        for test, patterns in tests.items():
            if test == "account":
                row["account"] = accounts[patterns[0]]
            elif test == "campaign":
                parts = sorted((text(p.lstrip("~")) for p in patterns), key=lambda p: (p.startswith("%"), not p.endswith("%")))
                row["campaign"] = " ".join(p.strip("%") for p in parts).replace("%", "")
            elif not test.startswith("not_"):
                row[test] = text(patterns[0].lstrip("~")).replace("%", "").replace("\\", "")
        for test in tests:
            if test.startswith("not_") and row[test[4:]] is None:
                row[test[4:]] = "other"
        rows.append(row)
    df = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(rows)], "i int, source string, medium string, campaign string, account long, category string")
    col = channel(*[F.col(c) for c in ("source", "medium", "campaign", "account", "category")], brand="acme", shop="acm", accounts=accounts)
    got = {r[0]: r[1] for r in df.select("i", col).collect()}
    won = [next((n for n, (_, tests) in enumerate(RULES) if holds(row, tests)), None) for row in rows]
    assert [got[i] for i in range(len(rows))] == ["Other" if n is None else RULES[n][0] for n in won]
    assert sum(n == i for i, n in enumerate(won)) > 0.8 * len(RULES)


def test_strict_item(spark):
    from brightledger.functions.columns import item_strict

    df = spark.createDataFrame([([1, 2],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(item_strict(F.col("a"), 1)).collect()] == [2, None]
    with pytest.raises(Exception, match="no element 2 in an array of 2"):
        df.select(item_strict(F.col("a"), 2)).collect()
