"""Rules from a table give what the CASE expression gives, also when there are thousands."""

import random
import re

from pyspark.sql import functions as F

from brightledger.functions.channels import RULES, channel
from brightledger.functions.rule_index import EVERY, _keys, channel_rules, classify

NAMES = {"brand": "glass", "shop": "shopx", "accounts": {"video": 1, "remarketing": 2}}
FIELDS = ["source", "medium", "category", "campaign", "account"]


def values(rng, field):
    """Values that some pattern of the field fits, and others."""
    patterns = [p for _, tests in RULES for t, ps in tests.items() if t.endswith(field) for p in ps] or ["x"]
    p = rng.choice(patterns).lstrip("~").replace("{brand}", "glass").replace("{shop}", "shopx").replace("{own}", "shop")
    text = re.sub("[%_]", lambda _: rng.choice(["", "q", "zz"]), p)
    return rng.choice([text, text, text.upper(), text + "x", None])


def test_table_equals_case(spark):
    rng = random.Random(1)
    rows = [(*(values(rng, f) for f in FIELDS[:4]), rng.choice([1, 2, 3, None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "source string, medium string, category string, campaign string, account long")
    want = df.select("*", channel(*(F.col(c) for c in ("source", "medium", "campaign", "account", "category")), **NAMES).alias("Media"))
    got = classify(df, channel_rules(spark, **NAMES), FIELDS, "Media")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert len({r["Media"] for r in got.collect()}) > 30


def test_thousands_of_rules(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 7)))
    rules = [(i, f"L{i}", [rng.choice([word(), word() + "%", "~" + word(), "%" + word() + word() + "%", word()[:2] + "_" + word()]) for _ in range(rng.randrange(1, 3))]) for i in rng.sample(range(20_000), 5000)]
    table = spark.createDataFrame(rules, "rule int, label string, source array<string>")
    rows = [(rng.choice([word(), word().upper(), None]),) for _ in range(400)]

    def fits(value, pattern):
        if value is None:
            return False
        fold = pattern.startswith("~")
        text = re.escape(pattern.lstrip("~")).replace("%", ".*").replace("_", ".")
        return re.fullmatch(text, value.lower() if fold else value, re.S) is not None

    ordered = sorted(rules)
    want = sorted(((v, next((label for _, label, ps in ordered if any(fits(v, p) for p in ps)), "Other")) for (v,) in rows), key=repr)
    got = classify(spark.createDataFrame(rows, "source string"), table, ["source"], "label")
    assert sorted(map(tuple, got.collect()), key=repr) == want
    keys = table.select(F.explode("source").alias("p")).select(_keys("source", F.col("p")).alias("k"))
    assert keys.where(F.col("k") == EVERY).count() < 0.5 * keys.count()
