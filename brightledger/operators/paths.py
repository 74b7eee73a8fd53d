"""Paths and carts: conversion paths, cohorts, cart segments and funnels, first-page features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.targets import stage
from ..functions.columns import bucket_ladder, from_seconds, has, local_day, to_zone
from .ordered import running
from .relational import semi_in
from .reports import flag_report
from .web import LA, SESSION, with_media

VISITS_PER_BUCKET = 512  # visits of one visitor that a running state handles in one task


# ---- conversion paths

def _campaign_type(text: str) -> Column:
    hit = has("campaign", text) | has("adContent", text) | has("keyword", text)
    return F.when(hit, f"{text.upper()} Campaign").otherwise(f"Non {text.upper()} Campaign")


TOUCH = ["Media", "Campaign_Type", "campaign", "adContent", "keyword"]


def touches(hits: DataFrame, ref: DataFrame, country: str = "United States", tag: str = "hto") -> DataFrame:
    """Sessions of known visitors with media and campaign, in UTC."""
    rows = hits.where((F.col("country") == country) & F.col("visitorKey").isNotNull()).select(
        "visitorKey", "visitStartTime", "source", "medium", "campaign", "adContent", "keyword", "customerId").distinct()
    rows = with_media(rows, ref).withColumn("Campaign_Type", _campaign_type(tag)).withColumn("Datetime", from_seconds("visitStartTime"))
    return rows.select("visitorKey", F.to_date("Datetime").alias("Date"), "Datetime", *TOUCH).distinct()


def transactions(hits: DataFrame, ref: DataFrame, country: str = "United States", tag: str = "hto") -> DataFrame:
    """Orders of known visitors that carry the trial flag, with the session's media and campaign."""
    rows = hits.where((F.col("country") == country) & F.col("visitorKey").isNotNull() & F.col("transactionId").isNotNull()
                      & F.col("isTrial").isNotNull())
    rows = rows.select("visitorKey", "visitStartTime", "transactionId", "source", "medium", "campaign", "adContent", "keyword",
                       "customerId", "isTrial").distinct()
    rows = with_media(rows, ref).withColumn("Campaign_Type", _campaign_type(tag))
    return rows.select("visitorKey", from_seconds("visitStartTime").alias("Datetime"), "transactionId", *TOUCH, "isTrial").distinct()


def conversion_path(touch: DataFrame, tx: DataFrame, media_types: DataFrame, days: int = 30) -> DataFrame:
    """Each order with the visitor's touches of the ``days`` days before, in time order.

    A visitor's touches of one day become one row first: its part of every path, and its first and last touch. An order is repeated
    for each of its days and meets those rows, so it never meets single touches, and its own group holds one row per day.
    First and last touch, days between them and the ``>>`` paths come from that group; nulls are left out of the paths.
    """
    platform = media_types.select("Media", "Platform").distinct()
    at = F.struct("Datetime", *TOUCH)
    within = ", ".join(["Datetime", *TOUCH])
    paths = {"Media_Funnel": "Media", "Platform_Funnel": "Platform", "Campaign_Type_Funnel": "Campaign_Type",
             "Campaign_Funnel": "campaign", "AdContent_Funnel": "adContent", "Keyword_Funnel": "keyword"}
    # a day of this column need not begin at midnight of the touch's own time, so a part is of one day of each
    daily = touch.join(platform, "Media", "left").groupBy("visitorKey", "Date", F.to_date("Datetime").alias("__own")).agg(
        F.min(at).alias("__lo"), F.max(at).alias("__hi"), *[F.expr(f"listagg({c}, '>>') within group (order by {within})").alias(n) for n, c in paths.items()])
    orders = tx.select("visitorKey", F.col("Datetime").alias("t_Date"), "transactionId", "isTrial",
                       *[F.col(c).alias(f"t_{c}") for c in TOUCH])
    spread = orders.withColumn("Date", F.explode(F.sequence(F.date_sub(F.to_date("t_Date"), days), F.to_date("t_Date"))))
    keys = ["visitorKey", "t_Date", "transactionId", "isTrial", "t_Campaign_Type", "t_campaign", "t_adContent", "t_keyword", "t_Media"]
    out = spread.join(daily, ["visitorKey", "Date"]).groupBy(*keys).agg(
        F.min("__lo").alias("first"), F.max("__hi").alias("last"),
        *[F.expr(f"listagg({n}, '>>') within group (order by __lo)").alias(n) for n in paths])
    named = {"Media": "Media", "campaign": "Campaign", "adContent": "AdContent", "keyword": "Keyword"}
    ends = [F.col(side)[c].alias(f"{side.capitalize()}_{n}") for c, n in named.items() for side in ("first", "last")]
    return out.select("visitorKey", "t_Date", "transactionId", "isTrial", "t_Campaign_Type", "t_campaign", "t_adContent", "t_keyword",
                      *ends, F.datediff(F.col("last")["Datetime"], F.col("first")["Datetime"]).alias("time_to_conversion"), *paths)


def exposure_cohort(hits: DataFrame, ref: DataFrame, day: date, until: date, hours: Sequence[int], media: Sequence[str],
                    country: str = "United States", tz: str = LA) -> DataFrame:
    """Visitors of one local day, split by exposure hours, with their orders of the days after."""
    local = to_zone(from_seconds("visitStartTime"), tz)
    base = hits.where((F.to_date(local) == F.lit(day)) & (F.col("country") == country) & F.col("visitorKey").isNotNull())
    base = with_media(base.select("visitorKey", "visitStartTime", "source", "medium", "campaign", "customerId").distinct(), ref)
    kind = F.when(F.hour(local).isin(list(hours)), "View").otherwise("Regular")
    base = base.where(F.col("Media").isin(list(media))).select("visitorKey", kind.alias("Hour_Type")).distinct()
    later = hits.where((F.to_date(local) > F.lit(day)) & (F.to_date(local) <= F.lit(until)) & F.col("transactionId").isNotNull())
    later = later.select("visitorKey", "transactionId").distinct()
    return base.join(later, "visitorKey", "left").select("visitorKey", "Hour_Type", "transactionId").distinct()


# ---- cohorts

def reset_cohort(visits: DataFrame, days: int = 30, source: str | None = None, tz: str = LA) -> DataFrame:
    """Days on which a visitor enters the cohort: never in it, or last in it at least ``days`` before.

    Each entry depends on the one before, so the visitor's distinct days (at most one per
    calendar day) are sorted and folded once. Attributes are those of the day's first visit.
    """
    rows = visits if source is None else visits.where(has("source", source) & ~has("medium", "referrer"))
    rows = rows.withColumn("base_date", local_day("visitStartTime", tz))
    firsts = rows.groupBy("fullVisitorId", "base_date").agg(F.min_by(
        F.struct("visitNumber", "campaign", "adContent", "keyword", "deviceCategory"),
        F.struct("visitStartTime", "visitNumber")).alias("f"))
    step = f"if(size(acc) = 0 or datediff(d, element_at(acc, -1)) >= {int(days)}, array_append(acc, d), acc)"
    entries = firsts.groupBy("fullVisitorId").agg(F.sort_array(F.collect_set("base_date")).alias("ds")).select(
        "fullVisitorId", F.explode(F.expr(f"aggregate(ds, cast(array() as array<date>), (acc, d) -> {step})")).alias("base_date"))
    return entries.join(firsts, ["fullVisitorId", "base_date"]).select(
        "base_date", F.col("fullVisitorId").alias("base_visitorId"), F.col("f.visitNumber").alias("base_visit"),
        "f.campaign", "f.adContent", "f.keyword", F.replace(F.col("f.deviceCategory"), F.lit("tablet"), F.lit("desktop")).alias("device"))


def cohort_products(items: DataFrame, hits: DataFrame, cohort: DataFrame, days: int = 28, tz: str = LA) -> DataFrame:
    """Items sold by frame, eyewear and lens type in orders of cohort members within ``days`` days."""
    member = cohort.select(F.col("base_visitorId").alias("fullVisitorId"), "base_visit",
                           F.explode(F.sequence("base_date", F.date_add("base_date", days - 1))).alias("Date"))
    tx = hits.where("transactionId is not null").select("fullVisitorId", "visitNumber", local_day("visitStartTime", tz).alias("Date"),
                                                        "transactionId").distinct()
    ids = tx.join(member, ["fullVisitorId", "Date"]).where("visitNumber >= base_visit").select("transactionId")
    return semi_in(items, F.col("Order_Number").cast("string"), ids).groupBy("FrameType", "EyewearType", "LensType").agg(
        F.sum("Item_Qty_Ordered").alias("items"))


# ---- subscription status of visitors

def visitor_subscription(hits: DataFrame, contacts: DataFrame, daily: DataFrame) -> DataFrame:
    """Sessions with a hashed address and the latest subscribe status known for it.

    Status is the last change of the address (case ignored), else the base status. The
    hash matches the address as stored first, then in lower case; one status per hash.
    """
    ts = F.coalesce("channels_email_subinfo_ts", "channels_email_unsubinfo_ts").try_cast("timestamp_ntz")
    status = F.col("channels_email_subscribeStatus")
    last = daily.groupBy(F.lower("channels_email_address").alias("low")).agg(
        F.max(F.struct(ts.alias("ts"), status.alias("s")))["s"].alias("changed"))
    base = contacts.select("channels_email_address", status.alias("base"))
    mails = base.join(daily.select("channels_email_address").distinct(), "channels_email_address", "full")
    mails = mails.join(last, F.lower("channels_email_address") == F.col("low"), "left").select(
        F.col("channels_email_address").alias("email"), F.coalesce("changed", "base").alias("status"))
    raw = mails.groupBy(F.md5("email").alias("h1")).agg(F.max("status").alias("s1"))
    low = mails.groupBy(F.md5(F.lower("email")).alias("h2")).agg(F.max("status").alias("s2"))
    seen = hits.where("hashedEmail is not null").select(*SESSION, F.col("hashedEmail").alias("hashed")).distinct()
    return (seen.join(raw, F.col("hashed") == F.col("h1"), "left").join(low, F.col("hashed") == F.col("h2"), "left")
            .select(*SESSION, "hashed", F.coalesce("s1", "s2").alias("subscribeStatus")))


# ---- cart segments

def _cart_event(text: str) -> Column:
    return has("eventCategory", "eec") & has("eventAction", "cart") & has("eventLabel", text)


def _minute() -> Column:
    return F.floor((F.col("visitStartTime") * 1000 + F.col("time")) / 60000)


def carts_with_orders(carts: DataFrame, hits: DataFrame, minutes: int = 60) -> DataFrame:
    """Last cart hit per session and matching order, and per session without one.

    A cart hit matches an order of the same or a later visit if the order comes at most
    ``minutes`` minutes after it (orders before it in the same visit match too). Visits of
    a visitor follow each other in time, as do hits of a visit. Instead of pairing every cart
    hit with every order of the visitor, a session's last cart hit is matched by session and by
    hour block, and hits without a match are found from the next order's minute.
    """
    hit = carts.select(*SESSION, "hitNumber", _minute().alias("m"))
    tx = hits.where("transactionId is not null").select(*SESSION, "transactionId", _minute().alias("tm")).distinct()
    last = hit.groupBy(*SESSION).agg(F.max("hitNumber").alias("hitNumber"), F.max("m").alias("m"))
    same = last.join(tx, SESSION).where(F.col("tm") - F.col("m") <= minutes)
    block = F.floor(F.col("m") / minutes)
    later_tx = tx.select("fullVisitorId", F.col("visitNumber").alias("tv"), "transactionId", "tm", F.floor(F.col("tm") / minutes).alias("blk"))
    later = (last.withColumn("blk", F.explode(F.array(block, block + 1))).join(later_tx, ["fullVisitorId", "blk"])
             .where((F.col("tv") > F.col("visitNumber")) & (F.col("tm") - F.col("m") <= minutes)))
    matched = same.select(*SESSION, "transactionId", "hitNumber").unionByName(later.select(*SESSION, "transactionId", "hitNumber")).distinct()
    # earliest order of this or a later visit
    visits = tx.groupBy(*SESSION).agg(F.min("tm").alias("tm")).unionByName(last.select(*SESSION, F.lit(None).cast("long").alias("tm")))
    visits = visits.groupBy(*SESSION).agg(F.min("tm").alias("tm"))
    ahead = running(visits, ["fullVisitorId"], F.floor(F.col("visitNumber") / VISITS_PER_BUCKET), [F.col("visitNumber")],
                    {"next": ("min", F.col("tm"))}, backward=True).select(*SESSION, "next")
    alone = (hit.join(ahead, SESSION, "left").where(F.col("next").isNull() | (F.col("next") - F.col("m") > minutes))
             .groupBy(*SESSION).agg(F.max("hitNumber").alias("hitNumber")))
    return matched.unionByName(alone.withColumn("transactionId", F.lit(None).cast("string")))


CLASSES = ["Accessories", "Upgrades", "Contacts", "Non_Premium_Non_Multi", "Non_Premium_Multi", "Premium_Non_Multi",
           "Premium_Multi", "MAP_Non_Multi", "MAP_Multi"]
MULTIFOCAL = ["Progressive", "Bifocal"]  # fixed values


def cart_products(picked: DataFrame, products: DataFrame, ref: DataFrame, media_types: DataFrame, map_brands: Sequence[str],
                  extra: Sequence[str] = (), tz: str = LA) -> DataFrame:
    """Products of the picked cart hits counted in nine classes with price sums.

    Equal brand and price within a cart count once. A null brand, lens or premium flag
    keeps a product out of the classes that test it.
    """
    kind, brand, lens = F.col("eyewearType"), F.col("productBrand"), F.col("lens")
    keys = ["Date", "deviceCategory", *extra, *SESSION, "Platform", "Media_Group", "Media", "transactionId"]
    rows = with_media(products.withColumn("Date", local_day("visitStartTime", tz)).drop("transactionId"), ref, media_types)
    rows = rows.join(picked, [*SESSION, "hitNumber"])
    flat = rows.groupBy(*keys, "productBrand", (F.col("productPrice") / 1_000_000).alias("price")).agg(
        F.max("lens").alias("lens"), F.max("isPremium").alias("isPremium"), F.max("eyewearType").alias("eyewearType"))
    frame = ~kind.isin("Contacts", "Accessories", "upgrade")
    mapped, multi = brand.isin(list(map_brands)), lens.isin(MULTIFOCAL)
    plain, premium = F.col("isPremium") != "1", F.col("isPremium") == "1"
    tests = {
        "Accessories": kind == "Accessories", "Upgrades": kind == "upgrade", "Contacts": kind == "Contacts",
        "Non_Premium_Non_Multi": frame & ~mapped & plain & ~multi, "Non_Premium_Multi": frame & ~mapped & plain & multi,
        "Premium_Non_Multi": frame & ~mapped & premium & ~multi, "Premium_Multi": frame & ~mapped & premium & multi,
        "MAP_Non_Multi": frame & mapped & ~multi, "MAP_Multi": frame & mapped & multi,
    }
    return flat.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("totalProducts"), F.sum("price").alias("totalPrice"),
        *[F.count(F.when(t, kind)).alias(n) for n, t in tests.items()],
        *[F.sum(F.when(t, F.col("price"))).alias(f"{n}_Price") for n, t in tests.items()])


def cart_segments(hits: DataFrame, products: DataFrame, ref: DataFrame, media_types: DataFrame, map_brands: Sequence[str],
                  by: str = "cart", status: DataFrame | None = None, tz: str = LA) -> DataFrame:
    """Users, sessions, buyers and orders per vector of product classes in the cart.

    ``cart`` starts from the last cart view of a session, classes as 0, 1, 2, >2. ``add``
    starts from adding to the cart and takes the last cart view after it, with subscription
    status and classes as true or false.
    """
    path = F.lower("pagePath")
    views = hits.where(_cart_event("products") & path.contains("checkout/cart"))
    if by == "cart":
        views = hits.where(_cart_event("products") & (path.contains("checkout/cart") | path.contains("checkout/onepage")))
        picked, extra = carts_with_orders(views, hits), []
    else:
        added = carts_with_orders(hits.where(_cart_event("addtocart")), hits)
        last = views.groupBy(*SESSION).agg(F.max("hitNumber").alias("view"))
        picked = added.join(last, SESSION).where("view > hitNumber").select(*SESSION, "transactionId", F.col("view").alias("hitNumber"))
        picked = picked.join(status.select(*SESSION, "subscribeStatus"), SESSION, "left")
        extra = ["subscribeStatus"]
    counted = cart_products(picked, products, ref, media_types, map_brands, extra, tz)
    vector = {c: bucket_ladder(c) if by == "cart" else F.coalesce(F.col(c), F.lit(0)) != 0 for c in CLASSES}
    counted = counted.withColumns({"Amount_Of_Products": bucket_ladder("totalProducts"), **vector})
    if extra:
        counted = counted.withColumn("subscribeStatus", F.coalesce("subscribeStatus", F.lit("unidentified")))
    bought = F.col("transactionId").isNotNull()
    dims = ["Date", "deviceCategory", *extra, "Platform", "Media_Group", "Media", "Amount_Of_Products", *CLASSES]
    return flag_report(counted, dims, {"Users": F.lit(True), "Purchasing_Users": bought},
                       {"Sessions": F.lit(True), "Purchasing_Sessions": bought}, orders="Orders", session="visitNumber")


# ---- cart funnel

def cart_funnel(hits: DataFrame, ref: DataFrame, status: DataFrame) -> DataFrame:
    """Carts before a purchase plus the purchase: path length, abandonment media in it, last media.

    A purchase is preceded by every earlier cart session of the visitor; visitors without a
    purchase form one path per status. Only the number of touches, whether one holds ``abn``
    and the last media are needed, so a running state over a visitor's visits replaces the
    pairs of cart sessions and purchases.
    """
    path = F.lower("pagePath")
    base = [*SESSION, "visitStartTime", "source", "medium", "campaign", "customerId"]
    # one row per session each: staged, as several branches read them
    known = stage(status.select(*SESSION, F.coalesce("subscribeStatus", F.lit("unidentified")).alias("status")))

    def sessions(df: DataFrame, *more: str) -> DataFrame:
        rows = with_media(df.select(*base, *more).distinct(), ref).join(known, SESSION, "left")
        return rows.select(*SESSION, *more, F.coalesce("status", F.lit("unidentified")).alias("status"),
                           F.coalesce(has("Media", "abn"), F.lit(False)).alias("abn"),
                           F.when(F.col("Media").isNotNull(), F.struct("visitStartTime", "visitNumber", "Media")).alias("last")).distinct()

    carts = stage(sessions(hits.where(_cart_event("products") & (path.contains("checkout/cart") | path.contains("checkout/onepage")))))
    tx = stage(sessions(hits.where("transactionId is not null"), "transactionId"))
    buyers = tx.select("fullVisitorId").distinct()
    state = ["fullVisitorId", "transactionId", "status", "n", "abn", "last"]
    none = F.lit(None).cast("string").alias("transactionId")
    open_paths = (carts.join(buyers, "fullVisitorId", "left_anti").groupBy("fullVisitorId", "status")
                  .agg(F.count(F.lit(1)).alias("n"), F.max("abn").alias("abn"), F.max("last").alias("last"))
                  .withColumn("transactionId", none).select(*state))
    before = carts.join(buyers, "fullVisitorId", "left_semi")
    statuses = before.select("fullVisitorId", "status").distinct()
    probes = tx.select(*SESSION, "transactionId").distinct().join(statuses, "fullVisitorId")
    lane = before.select(*SESSION, "status", "abn", "last", F.lit(1).alias("q")).unionByName(
        probes.withColumn("q", F.lit(0)), allowMissingColumns=True)  # a purchase sees visits before its own only
    seen = running(lane, ["fullVisitorId", "status"], F.floor(F.col("visitNumber") / VISITS_PER_BUCKET),
                   [F.col("visitNumber"), F.col("q"), F.col("transactionId")],
                   {"carts": ("sum", F.col("q").cast("long")), "any_abn": ("max", F.col("abn")), "top": ("max", F.col("last"))})
    preceded = seen.where("q = 0 and carts > 0").select("fullVisitorId", "transactionId", "status", F.col("carts").alias("n"),
                                                        F.col("any_abn").alias("abn"), F.col("top").alias("last"))
    own = tx.select("fullVisitorId", "transactionId", "status", F.lit(1).cast("long").alias("n"), "abn", "last")
    rows = stage(open_paths.unionByName(preceded.select(*state)).unionByName(own.select(*state)))
    paths = rows.groupBy("fullVisitorId", "transactionId", "status").agg(
        F.sum("n").alias("n"), F.max("abn").alias("abn"), F.max("last").alias("last"))
    points = rows.groupBy("fullVisitorId").agg(F.sum("n").alias("touch_points"))
    out = paths.join(points, "fullVisitorId").select(
        "fullVisitorId", "transactionId", F.col("status").alias("subscribeStatus"),
        F.when(F.col("touch_points") == 1, "Single Touch Point").otherwise("Multiple Touch Points").alias("funnel_length"),
        F.when(F.col("abn"), "Includes ABN").otherwise("Doesn't Include ABN").alias("contains_abn"),
        F.when(has(F.col("last")["Media"], "abn"), "ABN Last Media").otherwise("Non ABN Last Media").alias("abn_last"))
    return flag_report(out, ["subscribeStatus", "funnel_length", "contains_abn", "abn_last"], {"Users": F.lit(True)}, orders="Transactions")


# ---- features of the first pages

# Stock number prefixes and category page texts of premium goods.
PREMIUM_PREFIXES = ["34", "44", "91", "36", "62", "63", "46", "96", "92", "93"]
PREMIUM_CATEGORY_TEXTS = ["product_badge=127", "brand=", "ray-ban", "prada-eyewear", "gucci-eyewear", "versace-eyewear",
                          "michael-kors-eyewear", "coach-eyewear", "oakley-glasses", "designer-glasses"]


def first_pages_features(hits: DataFrame, products: DataFrame, k: int = 6, house: str = "35") -> DataFrame:
    """Features of first visits from the hits before page ``k``, with a premium-buyer label.

    Only visitors whose first-visit purchases are all premium or all not are kept. Hits
    without custom dimensions do not count; a hit counts once.
    """
    who = ["visitorKey", "visitNumber"]
    pages = hits.where((F.col("type") == "PAGE") & F.col("visitorKey").isNotNull() & (F.col("visitNumber") == 1)).select(*who, "hitNumber")
    nth = Window.partitionBy(*who).orderBy("hitNumber")
    limit = pages.withColumn("n", F.row_number().over(nth)).where(F.col("n") == k).select(*who, F.col("hitNumber").alias("limit"))

    sku = F.col("productSKU")
    first_visit = products.where((F.col("visitNumber") == 1) & F.col("visitorKey").isNotNull())
    premium = F.substring(sku, 1, 2).isin(PREMIUM_PREFIXES)
    target = F.when(premium, 1).when(~premium, 0)
    other = [~((F.substring(sku, 1, 1) == d) & (F.substring(sku, 4, 1) == "-")) for d in ("1", "2")]
    label = (first_visit.where((F.col("actionType") == "6") & other[0] & other[1]).groupBy("visitorKey", F.col("deviceCategory").alias("device_category"))
             .agg(F.min(target).alias("Target"), F.max(target).alias("hi")).where(F.col("Target") == F.col("hi")).drop("hi"))

    def early(df: DataFrame) -> DataFrame:
        return df.join(limit, who).where("hitNumber < limit")

    path, page = F.col("pagePath"), F.col("type") == "PAGE"
    product, cat = F.col("pageKind") == "PRODUCT", F.col("pageKind") == "CATEGORY"

    def any_of(texts: Sequence[str]) -> Column:
        out = F.lit(False)
        for t in texts:
            out = out | path.contains(t)
        return out

    premium_page = page & any_of([f"/{p}-" for p in PREMIUM_PREFIXES]) & product
    premium_cat = page & any_of(PREMIUM_CATEGORY_TEXTS) & cat
    brand_filter = (F.col("eventCategory").startswith("Category -") & (F.col("eventAction") == "Filter - Brand")
                    & ~F.col("eventLabel").isin("Open", "Closed"))

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(F.count_if(part), F.count_if(whole)), F.lit(0.0))

    dimmed = hits.where((F.col("visitNumber") == 1) & (F.col("pageKind").isNotNull() | F.col("isTrial").isNotNull()))
    seen = early(dimmed).groupBy("visitorKey").agg(
        share(premium_page, product).alias("PremiumPDPPercentage"), F.count_if(premium_page).alias("PremiumProductPageCount"),
        F.count_if(page & product).alias("ProductPageCount"), share(premium_cat, cat).alias("PremiumCategoryPagePercentage"),
        F.count_if(premium_cat).alias("PremiumCategoryPageCount"), F.count_if(page & cat).alias("CategoryPageCount"),
        F.count_if(brand_filter).alias("FilterByBrandCount"),
        F.when(F.count_if(page & path.contains(house) & product) > 0, 1).otherwise(0).alias("HouseProductCount"))
    prices = early(first_visit.where("actionType = '2'")).groupBy("visitorKey").agg(
        F.avg(F.col("productPrice") / 1_000_000).alias("AvgPrice"), F.min(F.col("productPrice") / 1_000_000).alias("MinPrice"))
    cart = early(first_visit.where("actionType = '3'")).groupBy("visitorKey").agg(
        F.when(F.count_if(premium) > 0, 1).otherwise(0).alias("premium_in_cart"))
    out = label.join(seen, "visitorKey", "left").join(prices, "visitorKey", "left").join(cart, "visitorKey", "left")
    return out.select("device_category", "PremiumPDPPercentage", "PremiumProductPageCount", "ProductPageCount",
                      "PremiumCategoryPagePercentage", "PremiumCategoryPageCount", "CategoryPageCount", "FilterByBrandCount",
                      "AvgPrice", "MinPrice", "premium_in_cart", "HouseProductCount", "Target")
