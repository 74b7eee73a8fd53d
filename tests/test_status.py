"""Monthly status: several classes in one pass, months that are not shuffled."""

from datetime import date, datetime

from brightledger.operators.status import monthly_status

CLASSES = ("Contact Lenses", "Eyeglasses")


def inputs(spark):
    items = spark.createDataFrame([("A@x", "Contact Lenses", datetime(2001, 3, 5)), ("a@X", "Eyeglasses", datetime(2001, 1, 9)), ("b@x", "Eyeglasses", datetime(2001, 4, 1)),
                                   ("c@x", "Contact Lenses", datetime(2001, 7, 1)), ("", "Eyeglasses", datetime(2001, 1, 1)), (None, "Eyeglasses", datetime(2001, 1, 1))],
                                  "customer_email string, EyewearType string, Creation_Datetime timestamp_ntz")
    created = spark.createDataFrame([("a@x", datetime(2001, 2, 2)), ("b@x", datetime(2000, 5, 5)), ("b@x", None)], "subscriber_email string, Datetime_Created timestamp_ntz")
    changes = spark.createDataFrame([("a@x", datetime(2001, 4, 1), "UNSUB"), ("b@x", datetime(2001, 5, 1), "UNSUB"), ("b@x", datetime(2001, 5, 2), "SUB"),
                                     ("b@x", datetime(2001, 9, 2), "UNSUB")], "subscriber_email string, Datetime_Changed timestamp_ntz, Change_to string")
    return items, created, changes


def test_classes_in_one_pass(spark):
    out = monthly_status(*inputs(spark), date(2001, 6, 20), CLASSES)
    got = {(r.audience, r.customer_email, r.MonthID.month): (r.Last_Status_in_month, r.Was_Sub) for r in out.collect()}
    a = {1: ("inActive", None), 2: ("Active", True), 3: ("Active", None), 4: ("inActive", None), 5: ("inActive", None), 6: ("inActive", None)}
    b = {4: ("Active", None), 5: ("Active", True), 6: ("Active", None)}
    want = {("Eyeglasses", "a@x", m): v for m, v in a.items()} | {("Contact Lenses", "a@x", m): v for m, v in a.items() if m > 2} | {("Eyeglasses", "b@x", m): v for m, v in b.items()}
    assert got == want and out.count() == len(want)
    for c in CLASSES:
        one = monthly_status(*inputs(spark), date(2001, 6, 20), c)
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, out.where(out.audience == c).drop("audience").collect()), key=repr)


def test_months_are_not_shuffled(spark):
    plan = monthly_status(*inputs(spark), date(2001, 6, 20), "Eyeglasses")._jdf.queryExecution().executedPlan().toString()
    assert "explode(sequence" in plan and "Exchange" not in plan[: plan.index("explode(sequence")]
