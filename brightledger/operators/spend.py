"""Ad spend: one spend table from several exports, and cohorts of ad results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shards import scan_shards
from ..sources.targets import snapshot
from .relational import not_in

DIMS = ["Platform", "Marketing_Channel", "Media", "Product_Group", "Device", "Date"]
OUT = ["Date", "Max_Date", "Platform", "Marketing_Channel", "Media", "Product_Group", "Device", "Spend", "Conversions", "Conversion_Revenue"]


def _summed(df: DataFrame, *more: str) -> DataFrame:
    return df.groupBy(*DIMS, *more).agg(*[F.sum(c).alias(c) for c in ("Spend", "Conversions", "Conversion_Revenue")])


def spend_union(main: DataFrame, excluded_media: Sequence[str], excluded_campaigns: DataFrame, partner: DataFrame, partner_name: tuple[str, str],
                manual: DataFrame, as_of: date, since: date, partner_since: date, campaigns: DataFrame | None = None,
                media_ref: DataFrame | None = None, media_types: DataFrame | None = None) -> DataFrame:
    """Spend by day, platform, media, product and device from all exports.

    The campaign-level export adds campaigns the main export lacks, the partner export adds
    days the main export lacks for its media, manual rows are added as they are. Rows are
    summed per campaign before the exclusion lists are joined.
    """
    yesterday = as_of - timedelta(days=1)
    rows = main.where(F.col("Date").between(F.lit(since), F.lit(yesterday)) & ~F.col("Media").isin(list(excluded_media)))
    rows = rows.select(F.col("traffic_source").alias("Platform"), "Marketing_Channel", "Media", F.col("Product").alias("Product_Group"), "Device",
                       "Date", F.col("cost").alias("Spend"), F.col("conversions").alias("Conversions"), F.col("revenue").alias("Conversion_Revenue"), "campaign")
    out = _summed(not_in(_summed(rows, "campaign"), F.col("campaign"), excluded_campaigns))
    if campaigns is not None:
        extra = campaigns.groupBy("campaign", "account", "Device", "Date").agg(
            F.sum("cost").alias("Spend"), F.sum("conversions").alias("Conversions"), F.sum("value").alias("Conversion_Revenue"))
        extra = not_in(extra, F.col("campaign"), main.select("campaign").distinct())
        ref = media_ref.where((F.lower("source") == "google") & (F.lower("medium") == "cpc")).select(
            F.lower("campaign").alias("c"), F.coalesce("adwords_account", F.lit(0)).alias("a"), "Media").distinct()
        extra = extra.join(ref, (F.lower("campaign") == F.col("c")) & (F.coalesce("account", F.lit(0)) == F.col("a")), "left")
        types = media_types.select(F.col("Media"), "Platform", "Product_Type").distinct()
        kind = F.when(F.col("Product_Type").contains("Contact"), "Contacts").otherwise(F.col("Product_Type"))
        extra = extra.join(types.withColumnRenamed("Media", "tm"), F.col("Media") == F.col("tm"), "left").select(
            "Platform", F.lit("Acquisition").alias("Marketing_Channel"), F.col("tm").alias("Media"), kind.alias("Product_Group"), "Device", "Date",
            "Spend", "Conversions", "Conversion_Revenue")
        out = out.unionByName(_summed(extra))
    platform, media = partner_name
    days = main.where((F.col("Media") == media) & (F.col("Date") >= F.lit(partner_since))).select("Date").distinct()
    alone = partner.where(F.col("Date") >= F.lit(partner_since)).groupBy("Date").agg(
        F.sum("spent").alias("Spend"), F.sum("conversions").alias("Conversions"), F.sum("revenue").alias("Conversion_Revenue"))
    alone = not_in(alone, F.col("Date"), days).select(
        F.lit(platform).alias("Platform"), F.lit("Acquisition").alias("Marketing_Channel"), F.lit(media).alias("Media"),
        F.lit("Glasses").alias("Product_Group"), F.lit("Desktop").alias("Device"), "Date", "Spend", "Conversions", "Conversion_Revenue")
    known = out.unionByName(alone).where("Media is not null").withColumn("Max_Date", F.lit(yesterday)).select(*OUT)
    return known.unionByName(manual.where("Date is not null").select(*OUT))


def _missing_campaigns(ad: DataFrame, campaign: DataFrame, start: date, end: date) -> DataFrame:
    """Campaign rows of the window whose campaign has no ad-level row in the months of the window."""
    listed = scan_shards(ad, start, end, "yyyyMM").select("Campaign_ID").distinct()
    rows = scan_shards(campaign, start, end, "yyyyMM").where(F.col("Date").between(F.lit(start), F.lit(end)))
    return not_in(rows, F.col("Campaign_ID"), listed)


def _ad_rows(ad: DataFrame, start: date, end: date, connection: str) -> DataFrame:
    rows = scan_shards(ad, start, end, "yyyyMM").withColumn("Date", F.col("Date").cast("date"))
    return rows.where(F.col("Date").between(F.lit(start), F.lit(end)) & (F.col("Connection_Name") == connection))


def ads_snapshot(ad: DataFrame, campaign: DataFrame, as_of: date, connection: str, days: int = 31) -> DataFrame:
    """Conversions of the last ``days`` days per ad and device, stamped with yesterday as cohort date.

    Campaigns without ad-level rows come from the campaign export, with null ad columns.
    """
    start, end = as_of - timedelta(days=days), as_of - timedelta(days=1)
    keys = ["Date", "Campaign_ID", "Ad_Group_ID", "Ad_ID", "Device"]
    some = (F.col("Conversions") > 0) | (F.col("ATC") > 0) | (F.col("Leads") > 0)
    rows = _ad_rows(ad, start, end, connection).where(some | (F.col("New_Customers") > 0))
    sums = [F.sum("Leads").alias("Leads"), F.sum("ATC").alias("ATC")]
    totals = [F.sum("Conversions").alias("Conversions"), F.sum("Value").alias("Conversion_Value")]
    per_ad = rows.groupBy(*keys).agg(*sums, F.sum("New_Customers").cast("long").alias("New_Customer_Conversions"), *totals)
    none = F.lit(None).cast("string")
    per_campaign = _missing_campaigns(ad, campaign, start, end).where(some).groupBy("Date", "Campaign_ID", "Device").agg(*sums, *totals)
    per_campaign = per_campaign.withColumns({"Ad_Group_ID": none, "Ad_ID": none, "New_Customer_Conversions": F.lit(None).cast("long")})
    return snapshot(per_ad.unionByName(per_campaign), as_of)


def ads_final(ad: DataFrame, campaign: DataFrame, as_of: date, connection: str, days: int = 31) -> DataFrame:
    """Impressions, clicks, spend and conversions per ad and device; campaign rows united by column name."""
    start, end = as_of - timedelta(days=days), as_of - timedelta(days=1)
    ad_cols = ["Ad_ID", "Ad_Name", "Ad_Group_ID", "Ad_Group_Name", "Ad_group_type"]
    sums = {"impressions": "Impressions", "top_impressions": "Top", "absolute_top_impressions": "Absolute_Top", "Clicks": "Clicks", "Spend": "Cost",
            "Conv": "Conversions", "Conv_Value": "Value"}
    aggs = [F.sum(c).alias(n) for n, c in sums.items()]
    per_ad = _ad_rows(ad, start, end, connection).groupBy("Date", "Campaign_ID", "Campaign_Name", *ad_cols, "Device").agg(*aggs)
    per_campaign = _missing_campaigns(ad, campaign, start, end).groupBy("Date", "Campaign_ID", "Campaign_Name", "Device").agg(*aggs)
    return per_ad.unionByName(per_campaign, allowMissingColumns=True)
