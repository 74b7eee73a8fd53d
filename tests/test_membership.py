"""The membership filter: no false negatives, few false positives, and rows that need no shuffle."""

from pyspark.sql import functions as F

from brightledger.operators.membership import bloom_filter
from brightledger.sources.targets import append_new, split_by


def test_filter_is_never_wrong(spark):
    held = spark.range(0, 30_000, 3).select(F.col("id").cast("string").alias("v")).unionByName(spark.createDataFrame([(None,)], "v string"))
    df = spark.range(30_000).select(F.when(F.col("id") % 10 != 9, F.col("id").cast("string")).alias("k"), "id")
    maybe, lacking = split_by(df, F.col("k"), held, "v")
    assert maybe.count() + lacking.count() == 30_000
    assert lacking.join(held, F.col("k") == F.col("v")).count() == 0
    true = df.join(held, F.col("k") == F.col("v")).count()
    assert true <= maybe.count() <= 1.03 * true
    assert "Exchange hashpartitioning(k" not in lacking._jdf.queryExecution().executedPlan().toString()


def test_empty_values(spark):
    df = spark.range(10)
    maybe, lacking = split_by(df, F.col("id"), df.where("false"), "id")
    assert maybe.count() == 0 and lacking.count() == 10


def test_new_rows_of_an_append_are_not_shuffled_again(spark):
    """Of a source of 2,000 rows half are new; only the others, and few more, reach the exact join."""
    target = spark.range(1000).select(F.col("id").alias("k"))
    out = append_new(target, spark.range(2000).select(F.col("id").alias("k")), "k")
    assert sorted(r.k for r in out.collect()) == list(range(2000))
    maybe, lacking = split_by(spark.range(2000), F.col("id"), target, "k")
    assert maybe.count() < 1040 and lacking.count() > 960


def test_a_value_is_one_row_of_the_filter(spark):
    built, words = bloom_filter(spark.range(10_000), "id")
    assert "Generate" not in built._jdf.queryExecution().executedPlan().toString()
    held = built.first().words
    assert len(held) == words and max(bin(w & (1 << 64) - 1).count("1") for w in held) <= 64 and sum(1 for w in held if w) > words / 2
