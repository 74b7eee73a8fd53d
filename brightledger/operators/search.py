"""Search queries: keyword classes, query and page reports, organic against paid."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shards import scan_shards


def classify_query(query: Column, top: Column, brand_terms: Sequence[str], exceptions: Sequence[str]) -> Column:
    """Brand, top industry keyword or other, by substrings; exceptions are no brand queries."""
    brand = F.lit(False)
    for term in brand_terms:
        brand = brand | query.contains(term)
    for term in exceptions:
        brand = brand & ~query.contains(term)
    return F.when(brand, "Brand").when(top.isNotNull(), "Top Industry Keyword").otherwise("Other")


def keyword_refresh(sheet: DataFrame) -> DataFrame:
    return sheet.where("Keyword is not null").select("Keyword")


def search_report(rows: DataFrame, keywords: DataFrame, min_impressions: int, brand_terms: Sequence[str], exceptions: Sequence[str],
                  start: date | None = None, end: date | None = None, country: str = "usa", page: bool = False) -> DataFrame:
    """Query rows of one country with enough impressions or a click, and their keyword class.

    The keyword list is made distinct, so rows do not multiply.
    """
    if start:
        rows = scan_shards(rows, start, None, "yyyyMM").where(F.col("Date").between(F.lit(start), F.lit(end)))
    rows = rows.where((F.col("Country") == country) & ((F.col("Impressions") >= min_impressions) | (F.col("Clicks") > 0)))
    listed = keywords.where("Keyword is not null").select("Keyword").distinct()
    out = rows.join(listed, F.col("Query") == F.col("Keyword"), "left")
    cat = classify_query(F.col("Query"), F.col("Keyword"), brand_terms, exceptions)
    return out.select("Date", "Device", "Query", cat.alias("Category"), *(["Page"] if page else []), "Impressions", "Clicks", "Total_Position")


def organic_paid(organic: DataFrame, paid: DataFrame, term: str | None = None) -> DataFrame:
    """Organic report rows with paid figures of the same day, device and query."""
    ads = paid.where((F.col("Cost") > 0) | (F.col("Conversions") > 0))
    if term:
        ads = ads.where(F.col("Search_Term") == term)
    ads = ads.groupBy(F.col("Date").cast("date").alias("Date"), F.col("Search_Term").alias("Query"), "Device").agg(
        F.sum("Cost").alias("Paid_Cost"), F.sum("Impressions").alias("Paid_Impressions"), F.sum("Clicks").alias("Paid_Clicks"),
        F.sum("Conversions").alias("Paid_Conversions"), F.sum("Value").alias("Paid_Conversions_Value"))
    return organic.join(ads, ["Date", "Device", "Query"], "left")
