"""Web session jobs: landing pages, media, popups, subscriptions, banners, small sites, offline events.

Inputs are flat hits (``sources.shards.flatten_hits``). Sessions are identified by
``fullVisitorId`` with ``visitNumber`` or ``visitId``; days are local to the given zone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.channels import channel
from ..functions.columns import has, local_day, path_only, to_zone, from_seconds
from ..functions.rules import path_type
from ..sources.shards import scan_shards
from ..sources.targets import append_new_nullsafe, missing_nullsafe
from .reports import flag_report

LA, NY = "America/Los_Angeles", "America/New_York"
PageRules = Sequence[tuple[str, str]]
SESSION = ["fullVisitorId", "visitNumber"]

def category() -> Column:
    return F.col("eventCategory")


def action() -> Column:
    return F.col("eventAction")


def label() -> Column:
    return F.col("eventLabel")


# ---- predicates shared by the reports (null labels make them null, which counts as false)

def shown() -> Column:
    return has(label(), "show") & ~has(label(), "reminder") & ~has(label(), "remainder")


def popup_shown(sms: bool) -> Column:
    """A popup display that counts in the reports; thank-you and already-subscribed ones do not."""
    kind = has(label(), "sms") if sms else ~has(label(), "sms")
    return (category() == "popups") & shown() & kind & ~has(label(), "subscribed-popup") & ~has(label(), "ty")


def popup_subscribed(sms: bool, text: str = "-subs", skip_subscribed: bool = True) -> Column:
    kind = has(label(), "sms") if sms else ~has(label(), "sms")
    cond = (F.lower(category()) == "popups") & has(label(), text) & ~has(label(), "error") & kind
    return cond & ~has(label(), "subscribed-popup") if skip_subscribed else cond


def registered(where: str | None = None) -> Column:
    cond = (F.lower(category()) == "newsletter registration") & (F.lower(action()) == "user subscribed")
    return cond & has(label(), where) if where else cond


def added_to_cart() -> Column:
    return (action() == "Cart") & (label() == "AddToCart")


def revenue() -> Column:
    return F.col("transactionRevenue") / 1_000_000


# ---- building blocks

def landing_page(hits: DataFrame, rules: PageRules) -> DataFrame:
    """First page of each session, without query string, and its page type. Ties at the first hit stay."""
    pages = hits.where("pagePath is not null").select(*SESSION, "hitNumber", "pagePath").distinct()
    first = F.rank().over(Window.partitionBy(*SESSION).orderBy("hitNumber"))
    return (pages.withColumn("r", first).where("r = 1")
            .select(*SESSION, path_only("pagePath").alias("landing_Page"),
                    path_type(path_only("pagePath"), rules).alias("landing_Page_Type")))


def with_media(df: DataFrame, ref: DataFrame, media_types: DataFrame | None = None) -> DataFrame:
    """Add ``Media`` by source, medium, campaign and account; the last two match null to null.

    The reference is made distinct first, so rows do not multiply. With ``media_types`` the
    platform and media group are added as well. No broadcast is forced: Spark picks one when
    the reference's size allows it.
    """
    e = ref.select(F.col("source").alias("__s"), F.col("medium").alias("__m"), F.col("campaign").alias("__c"),
                   F.col("adwords_account").alias("__a"), "Media").distinct()
    out = df.join(e, (F.lower("source") == F.col("__s")) & (F.lower("medium") == F.col("__m"))
                  & F.lower("campaign").eqNullSafe(F.col("__c")) & F.col("customerId").eqNullSafe(F.col("__a")),
                  "left").drop("__s", "__m", "__c", "__a")
    if media_types is None:
        return out
    groups = media_types.select("Media", "Platform", F.col("media_name_group").alias("Media_Group")).distinct()
    return out.join(groups, "Media", "left")


def first_touch(hits: DataFrame, ref: DataFrame, tz: str = LA) -> DataFrame:
    """Per visitor and local day, the media of the day's first visit."""
    visits = hits.select(local_day("visitStartTime", tz).alias("Date"), *SESSION, "visitStartTime", "source", "medium",
                         "campaign", "customerId").distinct()
    first = F.rank().over(Window.partitionBy("Date", "fullVisitorId").orderBy("visitNumber"))
    firsts = visits.withColumn("r", first).where("r = 1")
    return with_media(firsts, ref).select("Date", "fullVisitorId", "Media").distinct()


def classify(df: DataFrame, **shop) -> DataFrame:
    """Channel name per row of (source, medium, campaign, adwords_account[, category])."""
    cat = F.col("category") if "category" in df.columns else F.lit(None).cast("string")
    return df.withColumn("Media", channel(F.col("source"), F.col("medium"), F.col("campaign"),
                                          F.col("adwords_account"), cat, **shop))


def new_combinations(hits: DataFrame, ref: DataFrame) -> DataFrame:
    """Traffic combinations of recent sessions that the reference lacks, in lower case.

    Only the account matches null to null: a combination without campaign is always new.
    """
    seen = hits.select(F.lower("source").alias("source"), F.lower("medium").alias("medium"),
                       F.lower("campaign").alias("campaign"), F.col("customerId").alias("adwords_account")).distinct()
    return missing_nullsafe(seen, ref, ["source", "medium", "campaign"], ["adwords_account"])


def extend_reference(combinations: DataFrame, categories: DataFrame, ref: DataFrame, **shop) -> DataFrame:
    """Classified reference rows for combinations it lacks, campaigns joined to a message category.

    ``categories`` holds (message_name, category); names match without regard to case.
    """
    cats = categories.select(F.lower("message_name").alias("__n"), "category").distinct()
    known = combinations.join(cats, F.lower("campaign") == F.col("__n"), "left")
    rows = classify(known, **shop).select("source", "medium", "campaign", "adwords_account", "Media")
    return missing_nullsafe(rows, ref, ["source", "medium"], ["campaign", "adwords_account"])


def tag_traffic(df: DataFrame, stable_ids: Sequence[int] | None = None, snapshots: DataFrame | None = None) -> DataFrame:
    """``Traffic_Type``: Stable by a list of ad groups, or by the latest snapshot of (device, ad group)."""
    if snapshots is None:
        return df.withColumn("Traffic_Type", F.when(F.col("adGroupId").isin(list(stable_ids or [])), "Stable")
                             .otherwise("Other"))
    latest = snapshots.where(F.col("reportDate") == snapshots.agg(F.max("reportDate")).scalar())
    latest = latest.select("deviceCategory", "adGroupId", F.lit(True).alias("__stable")).distinct()
    return (df.join(latest, ["deviceCategory", "adGroupId"], "left")
            .withColumn("Traffic_Type", F.when(F.col("__stable"), "Stable").otherwise("Other")).drop("__stable"))


def popup_exposure(hits: DataFrame) -> DataFrame:
    """Sessions that saw a newsletter or text-message popup: one row each with two flags."""
    seen = hits.where((category() == "popups") & shown())
    return seen.groupBy(*SESSION).agg(F.max(~has(label(), "sms")).alias("NL_Pop"), F.max(has(label(), "sms")).alias("SMS_Pop"))


def subscription_pages(hits: DataFrame, rules: PageRules, kind: str = "newsletter", tz: str = LA) -> DataFrame:
    """Visitor, local day and page type of subscriptions, with the moment of the first one.

    Kinds: ``newsletter`` (popup or footer), ``registration`` (popup or registration event),
    ``sms`` and ``sms_any`` (also when the visitor was already subscribed).
    """
    footer = has(action(), "newsletter subscription") & has(label(), "success")
    cond = {
        "newsletter": F.coalesce(popup_subscribed(False), F.lit(False)) | footer,
        "registration": F.coalesce(popup_subscribed(False, skip_subscribed=False), F.lit(False)) | registered(),
        "sms": popup_subscribed(True),
        "sms_any": popup_subscribed(True, skip_subscribed=False),
    }[kind]
    return (hits.where(cond)
            .groupBy("fullVisitorId", local_day("visitStartTime", tz).alias("Date"),
                     path_type(path_only("pagePath"), rules).alias("Page_Type"))
            .agg(F.min(F.struct("visitStartTime", "hitNumber")).alias("first_at")))


def _one_page(pages: DataFrame, name: str) -> DataFrame:
    """First subscription page of a visitor's day, so that a report row is never counted twice."""
    return pages.groupBy("fullVisitorId", "Date").agg(
        F.min_by("Page_Type", F.struct("first_at", "Page_Type")).alias(name), F.lit(True).alias(f"has_{name}"))


# ---- subscription reports

def subscription_report(hits: DataFrame, ref: DataFrame, media_types: DataFrame, rules: PageRules, *,
                        variant: str = "rolling", media: str = "first_touch", stable_ids: Sequence[int] | None = None,
                        snapshots: DataFrame | None = None, tz: str = LA) -> DataFrame:
    """Daily subscription report by device, traffic type, media, landing page and subscription pages.

    ``rolling`` counts popup and footer subscriptions; ``split`` divides them into popup,
    one-tap, checkout, account and footer. Media come from the day's first visit or
    (``media='session'``) from each session. Exposure and subscription lookups hold one row
    per key, so displays and revenue are counted once per hit.
    """
    split = variant == "split"
    days = hits.withColumn("Date", local_day("visitStartTime", tz))
    base = tag_traffic(days, stable_ids, snapshots)
    base = base.withColumn("Device", F.when(F.lower("deviceCategory") == "mobile", "Mobile").otherwise("Desktop"))
    base = base.join(popup_exposure(hits), SESSION, "left")
    base = base.join(_one_page(subscription_pages(hits, rules, "registration" if split else "newsletter", tz),
                               "NL_Sub_Page"), ["fullVisitorId", "Date"], "left")
    base = base.join(_one_page(subscription_pages(hits, rules, "sms_any" if split else "sms", tz), "SMS_Sub_Page"),
                     ["fullVisitorId", "Date"], "left")
    base = base.join(landing_page(hits, rules).drop("landing_Page"), SESSION, "left")
    if media == "session":
        base = with_media(base, ref, media_types)
    else:
        groups = media_types.select("Media", "Platform", F.col("media_name_group").alias("Media_Group")).distinct()
        touch = first_touch(hits, ref, tz).join(groups, "Media", "left").drop("Media")
        base = base.join(touch, ["fullVisitorId", "Date"], "left")
    nl, sms = popup_shown(False), popup_shown(True)
    sub, sms_sub = F.col("has_NL_Sub_Page").isNotNull(), F.col("has_SMS_Sub_Page").isNotNull()
    popup = popup_subscribed(False)
    visitors = {
        "Users": F.lit(True), "Users_With_Popup": F.col("NL_Pop"), "Users_With_SMS_Popup": F.col("SMS_Pop"),
        "NL_Subscribers": sub & nl, "Non_NL_Subscribers": ~sub & nl,
        "SMS_Subscribers": sub & sms, "Non_SMS_Subscribers": ~sub & sms,
        "SMS_subs": popup_subscribed(True), "ATC": added_to_cart(),
        "Lens_Funnel_Start": has(action(), "lens funnel") & has(action(), "step 1"),
        "Initiate_Checkout": has("pagePath", "checkout/onepage"),
    }
    if split:
        visitors |= {
            "NL_subs": F.coalesce(popup, F.lit(False)) | registered(), "Popup_NL_subs": popup,
            "Onetap_NL_subs": registered("one tap"), "Checkout_NL_subs": registered("checkout"),
            "Account_NL_subs": registered("account"), "Footer_NL_subs": registered("footer"),
        }
    else:
        visitors |= {"NL_subs": popup,
                     "Footer_NL_subs": has(action(), "newsletter subscription") & has(label(), "success")}

    def times(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("long")

    sums = {
        "Popup_Shown": times(nl), "SMS_Popup_Shown": times(sms),
        "NL_Subscribers_Popup_Shown": times(sub & nl), "NL_Non_Subscribers_Popup_Shown": times(~sub & nl),
        "SMS_Subscribers_Popup_Shown": times(sms_sub & sms), "SMS_Non_Subscribers_Popup_Shown": times(~sms_sub & sms),
        "Revenue": revenue(),
    }
    dims = ["Date", "Device", "Traffic_Type", "Platform", "Media_Group", "landing_Page_Type", "NL_Sub_Page", "SMS_Sub_Page"]
    return flag_report(base, dims, visitors, sums=sums, orders="Transactions")


def popup_location(hits: DataFrame, ref: DataFrame, rules: PageRules, stable_ids: Sequence[int], tz: str = LA) -> DataFrame:
    """Popups shown and subscriptions by page type and action, for sessions that saw a popup."""
    exposed = hits.where((category() == "popups") & shown() & ~has(label(), "subscribed-popup-showed")
                         & ~has(label(), "ty-popup-showed")).select(*SESSION).distinct()
    inside = hits.join(exposed, SESSION, "left_semi")
    landing = landing_page(inside, rules).drop("landing_Page")
    touch = first_touch(inside, ref, tz)
    events = inside.where((category() == "popups") & (has(label(), "show") | has(label(), "-subs")) & ~has(label(), "reminder")
                          & ~has(label(), "remainder") & ~has(label(), "subscribed-popup") & ~has(label(), "ty-popup")
                          & ~has(label(), "error"))
    events = tag_traffic(events, stable_ids)
    rows = (events.withColumn("Date", local_day("visitStartTime", tz))
            .withColumn("Device", F.when(F.lower("deviceCategory") == "mobile", "Mobile").otherwise("Desktop"))
            .withColumn("Page_Type", path_type(path_only("pagePath"), rules))
            .join(landing, SESSION, "left").join(touch, ["fullVisitorId", "Date"], "left"))

    def times(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("long")

    return flag_report(
        rows, ["Date", "Device", "Traffic_Type", "Media", "landing_Page_Type", "Page_Type", "eventAction"],
        {"Users": F.lit(True)},
        sums={"NL_Popup_Shown": times(shown() & ~has(label(), "sms")), "SMS_Popup_Shown": times(shown() & has(label(), "sms")),
              "NL_subs": times(popup_subscribed(False)), "SMS_subs": times(popup_subscribed(True))})


# ---- banners

def banner_report(hits: DataFrame, ref: DataFrame, kind: str = "impression", tz: str = NY) -> DataFrame:
    """Banner impressions or clicks with the orders of the same session, and users of the segment.

    Sessions are joined to their orders after they are reduced to one row per session and
    banner; an order of a session counts under each banner of it, as does its revenue. Hits,
    displays and events count once, however many orders the session has.
    """
    place = ["Date", "deviceCategory", "country", "region", "Media"]
    banner = hits.where(has(action(), f"hp banner {kind}"))
    banner = with_media(banner.withColumn("Date", local_day("visitStartTime", tz)), ref)
    visits = banner.groupBy(*place, "fullVisitorId", "visitNumber", "visitStartTime").agg(
        F.count_distinct(path_only("pagePath")).alias("pages"), F.max("time").alias("last_ms"))
    # whole seconds between session start and the last banner hit
    spent = F.floor(F.col("last_ms") / 1000)
    users = visits.groupBy(*place, "fullVisitorId").agg(
        F.count(F.lit(1)).alias("v"), F.sum("pages").alias("p"), F.sum(spent).alias("t"))
    segment = users.groupBy(*place).agg(F.count("fullVisitorId").alias("Unique_Users"), F.sum("v").alias("Visits"),
                                        F.sum("p").alias("pageviews"), F.sum("t").alias("timeOnSite"))
    dims = ["Date", "isFirstVisit", "deviceCategory", "country", "region", "eventLabel", "eventAction", "Media"]
    per_visit = (banner.withColumn("isFirstVisit", F.when(F.col("visitNumber") == 1, "y").otherwise("n"))
                 .withColumn("eventLabel", F.lower(label())).withColumn("eventAction", F.lower(action()))
                 .groupBy(*dims, "fullVisitorId", "visitNumber")
                 .agg(F.sum("totalHits").alias("hits"), F.count(F.lit(1)).alias("n")))
    orders = (hits.where("transactionId is not null")
              .select(*SESSION, "transactionId", revenue().alias("amount")).distinct())
    per_session = orders.groupBy(*SESSION).agg(F.sum("amount").alias("amount"))
    joined = per_visit.join(per_session, SESSION, "left")
    counts = joined.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("Unique_Events"), F.sum("amount").alias("transactionRevenue"), F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    distinct_orders = (per_visit.join(orders.select(*SESSION, "transactionId"), SESSION)
                       .groupBy(*dims, "transactionId").agg(F.lit(1).alias("one"))
                       .groupBy(*dims).agg(F.count(F.lit(1)).alias("transactions")))
    both = counts.unionByName(distinct_orders, allowMissingColumns=True).groupBy(*dims).agg(
        *[F.sum(c).alias(c) for c in ("Unique_Events", "transactionRevenue", "hits", "n")],
        F.coalesce(F.sum("transactions"), F.lit(0)).cast("long").alias("transactions"))
    # the media of unclassified traffic is null and finds no segment row
    out = both.join(segment, place, "left")
    common = ["Date", "Media", "isFirstVisit", "deviceCategory", "country", "region", "eventLabel", "eventAction",
              "Unique_Events", "transactions", "transactionRevenue"]
    if kind == "impression":
        return out.select(*common, "Visits", "hits", "pageviews", "timeOnSite", F.col("n").alias("imp"), "Unique_Users")
    return out.select(*common, F.col("n").alias("Clicks"), "Unique_Users")


# ---- small landing sites

CLICKS = ["CTA", "Product", "Logo", "Category", "Content", "Footer", "Klarna"]


def minipage_daily(hits: DataFrame, ref: DataFrame, tz: str = NY, excluded_country: str = "Israel") -> DataFrame:
    """Sessions that landed on a small site: users, sessions, time, further pages, clicks, subscriptions, orders.

    Session and page seconds are taken once per session.
    """
    key = ["fullVisitorId", "visitId"]
    paged = hits.where("pagePath is not null")
    pages = paged.groupBy(*key, "pagePath").agg(F.max_by("time", "hitNumber").alias("page_end"),
                                                F.max(F.struct("hitNumber", "time")).alias("last"))
    visit = pages.groupBy(*key).agg(F.count_distinct(path_only("pagePath")).alias("pages"), F.max("last")["time"].alias("visit_end"))
    first = F.rank().over(Window.partitionBy(*key).orderBy("hitNumber"))
    landed = (paged.select(*key, "hitNumber", "pagePath", "hostname", "source", "medium", "campaign", "customerId", "bounces")
              .withColumn("r", first).where("r = 1").where(has("hostname", "minipage")).drop("r", "hitNumber"))
    landed = (with_media(landed, ref).join(pages.select(*key, "pagePath", "page_end"), [*key, "pagePath"])
              .join(visit, key)
              .select(*key, "Media", "bounces", "pages", path_only("pagePath").alias("page"),
                      F.floor(F.col("visit_end") / 1000).alias("Session_Time"),
                      F.floor(F.col("page_end") / 1000).alias("Page_Time")).distinct())
    inside = hits.where(F.col("country") != excluded_country).drop("bounces").join(landed, key)
    lp = category().contains("Marketing LP")
    flags = {"General_Click": lp & has(action(), "click") & ~has(action(), "color")}
    flags |= {f"{c}_Click": lp & action().contains(f"{c} Click") for c in CLICKS}
    popup = popup_subscribed(False, "-subsc", skip_subscribed=False)
    flags |= {"NL_subs": F.coalesce(popup, F.lit(False)) | registered(), "Popup_subs": popup,
              "Onetap_subs": registered("one tap"), "ATC": has(label(), "addtocart")}
    dims = ["Date", "deviceCategory", "page", "Media"]
    tx = inside.where("transactionId is not null").groupBy(*key, "transactionId").agg(F.lit(1).alias("one"))
    tx = tx.groupBy(*key).agg(F.count(F.lit(1)).alias("transactions"))
    visits = (inside.withColumn("Date", local_day("visitStartTime", tz))
              .groupBy(*dims, *key).agg(
                  F.first("Session_Time").alias("Session_Time"), F.first("Page_Time").alias("Page_Time"),
                  F.max(F.coalesce(F.col("bounces") > 0, F.lit(False))).alias("Session_Bounces"),
                  F.max(F.col("pages") > 1).alias("Continued_To_Additional_Pages"),
                  *[F.max(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
              .join(tx, key, "left"))
    people = ["Continued_To_Additional_Pages", *flags]
    users = visits.groupBy(*dims, "fullVisitorId").agg(
        F.count(F.lit(1)).alias("Sessions"), F.sum(F.col("Session_Bounces").cast("long")).alias("Session_Bounces"),
        F.sum("Session_Time").alias("Session_Time"), F.sum("Page_Time").alias("Page_Time"),
        F.sum(F.coalesce("transactions", F.lit(0))).alias("transactions"), *[F.max(n).alias(n) for n in people])
    return users.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("Users"),
        *[F.sum(n).alias(n) for n in ("Sessions", "Session_Bounces", "Session_Time", "Page_Time")],
        *[F.sum(F.col(n).cast("long")).alias(n) for n in people], F.sum("transactions").alias("transactions"))


def minipage_events(hits: DataFrame, ref: DataFrame, tz: str = NY, excluded_country: str = "Israel") -> DataFrame:
    """Users and events of small sites by action, label (null when it holds ``v2``) and page."""
    rows = hits.where((F.col("country") != excluded_country) & has("hostname", "minipage")
                      & category().contains("Marketing LP"))
    rows = with_media(rows.withColumn("Date", local_day("visitStartTime", tz)), ref)
    rows = (rows.withColumn("eventLabel", F.when(~F.coalesce(label().contains("v2"), F.lit(False)), label()))
            .withColumn("Page", path_only("pagePath")))
    return flag_report(rows, ["Date", "deviceCategory", "Media", "eventAction", "eventLabel", "Page"],
                       {"Users": F.lit(True)}, sums={"Total": F.lit(1)})


# ---- offline events

def event_impact(hits: DataFrame, ref: DataFrame, name: str, day: date, spend: float, grain: str = "hour",
                 tz: str = LA, before: int = 28, after: int = 7) -> DataFrame:
    """Traffic around a dated offline event by hour or day, media, device and country.

    The daily form starts ``before`` days ahead of the ISO Monday on or before the event.
    """
    start = day - timedelta(days=before + (day.weekday() if grain == "day" else 0))
    rows = scan_shards(hits, start, day + timedelta(days=after))
    local = to_zone(from_seconds("visitStartTime"), tz)
    rows = (with_media(rows.withColumn("Date", F.to_date(local)), ref)
            .withColumn("Event_Name", F.lit(name)).withColumn("Event_Date", F.lit(day))
            .withColumn("Event_Spend", F.lit(float(spend))).withColumnRenamed("deviceCategory", "Device"))
    dims = ["Event_Name", "Event_Date", "Date", "Media", "Device", "country", "Event_Spend"]
    if grain == "hour":
        rows = rows.withColumn("Day", F.date_format(local, "EEEE")).withColumn("Hour", F.hour(local))
        dims += ["Day", "Hour"]
    atc = added_to_cart()
    return flag_report(
        rows, dims,
        visitors={"Users": F.lit(True), "New_Users": F.col("visitNumber") == 1},
        sessions={"Visits": F.lit(True),
                  "NL_subs": popup_subscribed(False, "-subsc", skip_subscribed=False),
                  "SMS_subs": popup_subscribed(True, "-subsc", skip_subscribed=False),
                  "Unique_ATC": atc, "Cart": has("pagePath", "checkout/cart"),
                  "Initiate_Checkout": has("pagePath", "checkout/onepage")},
        sums={"ATC": F.coalesce(atc, F.lit(False)).cast("long"), "Revenue": revenue()}, orders="Transactions")


def extend_media(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Media reference after new classified rows are appended."""
    return append_new_nullsafe(target, rows, ["source", "medium"], ["campaign", "adwords_account"])
