"""Scans of date-partitioned tables and of nested session rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FORMATS = {"yyyyMMdd": "%Y%m%d", "yyyyMM": "%Y%m"}


def shard_text(day: date, fmt: str = "yyyyMMdd") -> str:
    return day.strftime(FORMATS[fmt])


def read_shards(spark: SparkSession, path: str, start: date | None, end: date | None = None,
                fmt: str = "yyyyMMdd") -> DataFrame:
    """Read a parquet table partitioned by ``shard`` for a closed date range.

    ``shard`` is read as text so that the filter reaches the partition listing. Same-day
    tables named ``intraday_yyyyMMdd`` pass with their day. ``end=None`` leaves the range open.
    """
    schema = StructType([StructField(f.name, StringType() if f.name == "shard" else f.dataType, f.nullable)
                         for f in spark.read.parquet(path).schema])
    return scan_shards(spark.read.schema(schema).parquet(path), start, end, fmt)


def scan_shards(df: DataFrame, start: date | None, end: date | None = None,
                fmt: str = "yyyyMMdd", column: str = "shard") -> DataFrame:
    """Keep shards between two dates (text comparison, both ends included)."""
    lo = shard_text(start, fmt) if start else None
    hi = shard_text(end, fmt) if end else None
    return df.where(_in_range(F.col(column), lo, hi) | _in_range(F.col(column), lo, hi, "intraday_"))


def _in_range(shard: Column, lo: str | None, hi: str | None, prefix: str = "") -> Column:
    # the digits decide; the prefix bounds keep plain and same-day shards apart
    cond = shard.startswith(prefix) if prefix else F.lit(True)
    if lo:
        cond = cond & (shard >= prefix + lo)
    if hi:
        cond = cond & (shard <= prefix + hi)
    elif not prefix:
        cond = cond & (shard < "a")
    return cond


def scan_ingested(df: DataFrame, since: date, column: str = "ingest_ts") -> DataFrame:
    """Keep rows whose ingestion partition is at or after a day."""
    return df.where(F.col(column) >= F.lit(since.isoformat()).cast("timestamp_ntz"))


def flatten(df: DataFrame, array: str, alias: str, outer: bool = False) -> DataFrame:
    """One row per array item; empty arrays vanish unless ``outer``."""
    explode = F.explode_outer if outer else F.explode
    return df.select("*", explode(F.col(array)).alias(alias))


def dimension(dims: Column, index: int) -> Column:
    """Largest value stored under an index of a repeated (index, value) dimension."""
    return F.array_max(F.transform(F.filter(dims, lambda d: d["index"] == index), lambda d: d["value"]))


HIT_COLUMNS = [
    "fullVisitorId", "visitId", "visitNumber", "visitStartTime", "shard", "deviceCategory", "country",
    "region", "source", "medium", "campaign", "keyword", "adContent", "customerId", "adGroupId",
    "totalHits", "bounces", "visitorKey", "hashedEmail", "hitNumber", "time", "type", "pagePath",
    "hostname", "eventCategory", "eventAction", "eventLabel", "actionType", "transactionId",
    "transactionRevenue", "isTrial", "pageKind",
]

# Indexes of the custom dimensions the jobs read.
VISITOR_KEY, TRIAL_FLAG, HASHED_EMAIL, PAGE_KIND = 10, 19, 46, 48
PREMIUM_FLAG, LENS, EYEWEAR_TYPE = 18, 23, 60


def flatten_hits(sessions: DataFrame, level: str = "hit") -> DataFrame:
    """Nested session rows to one row per hit, product or product dimension.

    ``hit`` gives the flat columns the other web jobs take. ``product`` adds one row per
    product of a hit and ``dimension`` one per custom dimension of a product. Sessions
    without hits and hits without products disappear, as with a comma join to the array.
    """
    hits = flatten(sessions, "hits", "hit")
    base = [
        F.col("fullVisitorId"), F.col("visitId"), F.col("visitNumber"), F.col("visitStartTime"), F.col("shard"),
        F.col("device.deviceCategory").alias("deviceCategory"), F.col("geoNetwork.country").alias("country"),
        F.col("geoNetwork.region").alias("region"),
        *[F.col(f"trafficSource.{c}").alias(c) for c in ("source", "medium", "campaign", "keyword", "adContent")],
        F.col("trafficSource.adwordsClickInfo.customerId").alias("customerId"),
        F.col("trafficSource.adwordsClickInfo.adGroupId").alias("adGroupId"),
        F.col("totals.hits").alias("totalHits"), F.col("totals.bounces").alias("bounces"),
        dimension(F.col("customDimensions"), VISITOR_KEY).alias("visitorKey"),
        dimension(F.col("customDimensions"), HASHED_EMAIL).alias("hashedEmail"),
        F.col("hit.hitNumber").alias("hitNumber"), F.col("hit.time").alias("time"), F.col("hit.type").alias("type"),
        F.col("hit.page.pagePath").alias("pagePath"), F.col("hit.page.hostname").alias("hostname"),
        *[F.col(f"hit.eventInfo.{c}").alias(c) for c in ("eventCategory", "eventAction", "eventLabel")],
        F.col("hit.ecommerceAction.action_type").alias("actionType"),
        F.col("hit.transaction.transactionId").alias("transactionId"),
        F.col("hit.transaction.transactionRevenue").alias("transactionRevenue"),
        dimension(F.col("hit.customDimensions"), TRIAL_FLAG).alias("isTrial"),
        dimension(F.col("hit.customDimensions"), PAGE_KIND).alias("pageKind"),
    ]
    if level == "hit":
        return hits.select(*base)
    products = flatten(hits, "hit.product", "product")
    base += [F.col("product.productSKU").alias("productSKU"), F.col("product.productBrand").alias("productBrand"),
             F.col("product.productPrice").alias("productPrice")]
    if level == "product":
        dims = F.col("product.customDimensions")
        return products.select(*base, dimension(dims, LENS).alias("lens"),
                               dimension(dims, PREMIUM_FLAG).alias("isPremium"),
                               dimension(dims, EYEWEAR_TYPE).alias("eyewearType"))
    if level == "dimension":
        dims = flatten(products, "product.customDimensions", "dim")
        return dims.select(*base, F.col("dim.index").alias("dimIndex"), F.col("dim.value").alias("dimValue"))
    raise ValueError(f"unknown level {level!r}")
