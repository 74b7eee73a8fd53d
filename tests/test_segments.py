"""Segments of customers as of a day."""

from datetime import date, datetime


def test_segments_read_only_orders_of_customers_asked_for(spark, monkeypatch):
    from brightledger.operators import email as E

    seen, run = [], E.running
    monkeypatch.setattr(E, "running", lambda df, *a, **k: (seen.append(df), run(df, *a, **k))[1])
    items = spark.createDataFrame([("A@x", datetime(2024, 1, i), i, "Eyeglasses", "Bifocal", "p") for i in (1, 2, 5)] + [("other@x", datetime(2024, 1, 1), 9, "Eyeglasses", "Bifocal", "p")],
                                  "customer_email string, Creation_Datetime timestamp_ntz, Order_Number long, EyewearType string, LensType string, brand string")
    keys = spark.createDataFrame([("a@X", date(2024, 1, 3)), ("none@x", date(2024, 1, 3)), (None, date(2024, 1, 3))], "email string, day date")
    out = E.segment_asof(keys, items, {"orders": ([(1, "1"), (2, "2")], "3+"), "days": ([(7, "0-7")], "8+"), "premium": ["p"]})
    assert {(r.email, r.noOfOrders, r.daySinceLastOrder) for r in out.collect()} == {("a@X", "2", "0-7"), ("none@x", "Unknown", "Unknown"), (None, "Unknown", "Unknown")}
    assert {r[0] for r in seen[0].select("__e").collect()} == {"a@x"}
