"""The supplied test tables in the shape the jobs expect.

Each function derives one input table from the parquet files of a scale folder. ``k`` is
the number inside ``props``. Nothing here is part of a job: a user passes own tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros, from_seconds
from ..operators.ordered import numbered
from .targets import stage

ACCOUNT = 4242424242
HITS_PER_ROW = 500  # a nested session row holds at most so many hits; longer sessions continue on further rows


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _visits(ev: DataFrame) -> DataFrame:
    """One row per visitor and day with the attributes a session carries."""
    first = F.struct("ts", "event_id")
    visits = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("start"), F.min_by("k", first).alias("fk"), F.count(F.lit(1)).alias("totalHits"))
    return visits.select(
        "user_id", "day", "fk", "totalHits",
        F.expr("cast(user_id as string)").alias("fullVisitorId"),
        F.row_number().over(Window.partitionBy("user_id").orderBy("day")).cast("long").alias("visitNumber"),
        F.floor(epoch_micros("start") / 1_000_000).alias("visitStartTime"),
        F.date_format("day", "yyyyMMdd").alias("shard"),
        F.expr("element_at(array('mobile','desktop','tablet'), cast(user_id % 3 + 1 as int))").alias("deviceCategory"),
        F.expr("element_at(array('United States','Canada','Israel','Mexico'), cast(user_id % 4 + 1 as int))")
        .alias("country"),
        F.expr("'R' || user_id % 6").alias("region"),
        F.expr("element_at(array('google','Bing','facebook','newsletter','(direct)'), fk % 5 + 1)").alias("source"),
        F.expr("element_at(array('cpc','organic','email'), fk % 3 + 1)").alias("medium"),
        F.expr("element_at(array(null,'shopbrand core','au pla','discovery contact','conta private lab',"
               "'HTO trial','cart abn'), fk % 7 + 1)").alias("campaign"),
        F.expr("'kw' || fk % 4").alias("keyword"),
        F.expr("case when fk % 6 <> 0 then 'ad' || fk % 6 end").alias("adContent"),
        F.expr(f"case when fk % 2 = 1 then {ACCOUNT}L end").alias("customerId"),
        F.expr("cast(1000 + fk % 10 as bigint)").alias("adGroupId"),
        F.expr("case when totalHits = 1 then 1L end").alias("bounces"),
        F.expr("'V' || user_id").alias("visitorKey"),
        F.expr("case when user_id % 5 <> 0 then md5(case when user_id % 4 = 2 then 'U' else 'u' end "
               "|| user_id || '@x') end").alias("hashedEmail"),
    ).withColumn("visitId", F.col("visitStartTime"))


_HIT_EXPR = {
    "type": "case when event_type = 'view' then 'PAGE' else 'EVENT' end",
    "pagePath": """case event_type
        when 'view' then case k % 3 when 0 then '/p/' || lpad(cast(k as string), 2, '0') || '-item?x=' || k
            when 1 then case when k % 4 = 0 then '/c/designer-glasses?x=' || k else '/c/all?x=' || k end
            else '/cms/' || k || '?x=' || k end
        when 'click' then case when k % 8 = 2 then '/checkout/cart?x=' || k
            when k % 8 = 6 then '/checkout/onepage?x=' || k
            when k % 4 = 0 then '/p/' || lpad(cast(k as string), 2, '0') || '-item?x=' || k
            else '/cms/' || k end
        when 'signup' then '/account/' || k
        when 'purchase' then '/checkout/success?x=' || k
        else case when k % 2 = 0 then '/home' else '/mini/' || k % 5 || '?x=' || k end end""",
    "hostname": "case when event_type = 'error' and k % 2 = 1 then 'minipage.shop' else 'www.shop' end",
    "eventCategory": """case event_type
        when 'view' then case when k % 15 = 10 then 'Category - all' end
        when 'click' then case when k % 2 = 0 then 'EEC' else 'popups' end
        when 'signup' then case when k < 50 then 'popups' else 'Newsletter Registration' end
        when 'error' then case when k % 2 = 0 then 'HP' else 'Shop Marketing LP' end end""",
    "eventAction": """case event_type
        when 'view' then case when k % 15 = 10 then 'Filter - Brand' end
        when 'click' then case when k % 2 = 0 then 'Cart' else 'Popup' end
        when 'signup' then case when k < 50 then 'Popup' when k % 10 = 9 then 'Newsletter subscription'
            else 'User Subscribed' end
        when 'error' then case when k % 4 = 0 then 'HP Banner Impression' when k % 2 = 0 then 'HP Banner Click'
            else element_at(array('CTA Click','Product Click','Logo Click','Footer Click color'), cast(k % 8 div 2 + 1 as int))
            end end""",
    "eventLabel": """case event_type
        when 'view' then case when k % 15 = 10 then case when k % 2 = 0 then 'Open' else 'Brand X' end end
        when 'click' then case when k % 4 = 0 then 'AddToCart' when k % 4 = 2 then 'Products'
            else element_at(array('sms-popup-Show','nl-popup-Showed','nl-popup-reminder-show',
                'subscribed-popup-showed','ty-popup-showed'), cast(k % 10 div 2 + 1 as int)) end
        when 'signup' then case when k < 50 then case when k % 2 = 1 then 'sms-popup-subscribe'
                when k % 10 = 8 then 'nl-popup-subscribe-error' else 'nl-popup-subscribe' end
            when k % 10 = 9 then 'success'
            else element_at(array('One Tap','checkout','account','footer'), k % 4 + 1) end
        when 'error' then case when k % 2 = 0 then 'Slide ' || k % 3 when k % 5 = 0 then 'v2 block'
            else 'block ' || k % 3 end end""",
    "actionType": """case when event_type = 'view' and k % 3 = 0 then '2'
        when event_type = 'click' and k % 4 = 0 then '3' when event_type = 'purchase' then '6' end""",
    "transactionId": "case when event_type = 'purchase' then cast(event_id as string) end",
    "transactionRevenue": "case when event_type = 'purchase' then cast(round(value * 1000000) as bigint) end",
    "isTrial": "case when event_type = 'purchase' then case when k % 3 = 0 then '1' else '0' end end",
    "pageKind": "case when event_type = 'view' then element_at(array('PRODUCT','CATEGORY','CMS'), k % 3 + 1) end",
}


def hits(spark: SparkSession, sf: str) -> DataFrame:
    """Flat hits: one row per event, a session per visitor and day."""
    from .shards import HIT_COLUMNS

    ev = events(spark, sf).withColumn("day", F.to_date("ts"))
    ordered = numbered(ev, ["user_id", "day"], F.hour("ts") * 60 + F.minute("ts"),
                       [F.col("ts"), F.col("event_id")], "hitNumber")
    joined = ordered.join(_visits(events(spark, sf)), ["user_id", "day"])
    joined = joined.withColumn("time", F.floor(epoch_micros("ts") / 1000) - F.col("visitStartTime") * 1000)
    for name, text in _HIT_EXPR.items():
        joined = joined.withColumn(name, F.expr(text))
    return joined.select(*HIT_COLUMNS, "event_id", "k")


def staged_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits for jobs that read them several times: built once, then read by column."""
    return stage(hits(spark, sf))


def hit_products(spark: SparkSession, sf: str, flat: DataFrame | None = None) -> DataFrame:
    """Products of cart, add-to-cart, detail and purchase hits: one to three parts per hit."""
    flat = hits(spark, sf) if flat is None else flat
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    top = part.agg(F.max("p_partkey") + 1).scalar()
    shown = flat.where("actionType is not null or eventLabel = 'Products'")
    items = (shown.select("*", F.explode(F.expr("sequence(0, k % 3)")).alias("i"))
             .withColumn("p_partkey", F.pmod(F.col("event_id") * 31 + F.col("i") * 17, top)))
    return items.join(part, "p_partkey").select(
        *flat.columns,
        F.expr("cast(p_partkey % 90 + 10 as string) || '-' || p_partkey").alias("productSKU"),
        F.col("p_brand").alias("productBrand"),
        F.expr("cast(round(p_retailprice * 1000000) as bigint)").alias("productPrice"),
        F.expr("element_at(array('Progressive','Single Vision','Bifocal'), p_size % 3 + 1)").alias("lens"),
        F.expr("cast(p_size % 2 as string)").alias("isPremium"),
        F.expr("case p_size % 5 when 0 then 'Contacts' when 1 then 'Accessories' "
               "else case when p_size % 10 = 7 then 'upgrade' else 'Glasses' end end").alias("eyewearType"))


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Nested session rows as a web-analytics export delivers them."""
    flat = hits(spark, sf)
    products = hit_products(spark, sf, flat).groupBy("event_id").agg(F.collect_list(F.struct(
        "productSKU", "productBrand", "productPrice",
        F.array(F.struct(F.lit(23).cast("long").alias("index"), F.col("lens").alias("value")),
                F.struct(F.lit(18).cast("long").alias("index"), F.col("isPremium").alias("value")),
                F.struct(F.lit(60).cast("long").alias("index"), F.col("eyewearType").alias("value")))
        .alias("customDimensions"))).alias("product"))
    dims = F.filter(F.array(F.struct(F.lit(19).cast("long").alias("index"), F.col("isTrial").alias("value")),
                            F.struct(F.lit(48).cast("long").alias("index"), F.col("pageKind").alias("value"))),
                    lambda d: d["value"].isNotNull())
    hit = F.struct(
        "hitNumber", "time", "type", F.struct("pagePath", "hostname").alias("page"),
        F.struct("eventCategory", "eventAction", "eventLabel").alias("eventInfo"),
        F.struct(F.col("actionType").alias("action_type")).alias("ecommerceAction"),
        F.struct("transactionId", "transactionRevenue").alias("transaction"),
        dims.alias("customDimensions"), "product")
    keys = ["fullVisitorId", "visitId", "visitNumber", "visitStartTime", "shard", "deviceCategory", "country",
            "region", "source", "medium", "campaign", "keyword", "adContent", "customerId", "adGroupId",
            "totalHits", "bounces", "visitorKey", "hashedEmail"]
    nested = (flat.join(products, "event_id", "left")
              .groupBy(*keys, F.floor(F.col("hitNumber") / HITS_PER_ROW).alias("part"))
              .agg(F.sort_array(F.collect_list(hit)).alias("hits")))
    return nested.select(
        "fullVisitorId", "visitId", "visitNumber", "visitStartTime", "shard",
        F.struct("deviceCategory").alias("device"), F.struct("country", "region").alias("geoNetwork"),
        F.struct(F.col("totalHits").alias("hits"), "bounces").alias("totals"),
        F.struct("source", "medium", "campaign", "keyword", "adContent",
                 F.struct("customerId", "adGroupId").alias("adwordsClickInfo")).alias("trafficSource"),
        F.filter(F.array(F.struct(F.lit(10).cast("long").alias("index"), F.col("visitorKey").alias("value")),
                         F.struct(F.lit(46).cast("long").alias("index"), F.col("hashedEmail").alias("value"))),
                 lambda d: d["value"].isNotNull()).alias("customDimensions"),
        "hits")


def media_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Known traffic combinations (lower case) with a media name; every fifth one is missing."""
    seen = (_visits(events(spark, sf)).groupBy(
        F.lower("source").alias("source"), F.lower("medium").alias("medium"), F.lower("campaign").alias("campaign"),
        F.col("customerId").alias("adwords_account")).agg(F.min("fk").alias("fk")))
    return seen.where("fk % 5 <> 4 or fk % 3 = 0").select(
        "source", "medium", "campaign", "adwords_account",
        F.expr("case when campaign = 'cart abn' then 'Newsletter Abn' else source || ' ' || medium end").alias("Media"))


def media_type(spark: SparkSession, sf: str) -> DataFrame:
    media = media_reference(spark, sf).select("Media").distinct()
    return media.select("Media", F.expr("upper(left(Media, 2))").alias("Platform"),
                        F.expr("case when Media like '%organic' then 'Organic' else 'Paid' end").alias("media_name_group"),
                        F.expr("case when Media like 'g%' then 'Contact Lenses' else 'Glasses' end").alias("Product_Type"))


def stable_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Dated snapshots of ad groups with stable traffic."""
    return (_visits(events(spark, sf)).where("adGroupId % 4 = 1")
            .select(F.expr("date_sub(day, cast(dayofmonth(day) % 3 as int))").alias("reportDate"),
                    "deviceCategory", "adGroupId").distinct())


# ---- orders

def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Order items: line items with their order and part."""
    li = table(spark, sf, "lineitem").drop("l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    df = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return df.select(
        F.col("o_orderkey").alias("Order_Number"),
        F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int))").alias("Creation_Datetime"),
        F.expr(EMAIL).alias("customer_email"), F.expr(EYEWEAR).alias("EyewearType"),
        F.expr("case when p_size % 5 = 0 then 'Contact Lenses' else p_type end").alias("FrameType"),
        F.expr("element_at(array('Progressive','Single Vision','Bifocal'), p_size % 3 + 1)").alias("LensType"),
        F.col("p_brand").alias("brand"), F.col("p_name").alias("Item_Name"),
        F.expr("case when o_orderkey % 2 = 0 then 'Main' else 'AU' end").alias("Store"),
        F.expr("element_at(array('mobile','desktop','tablet'), cast(o_orderkey % 3 + 1 as int))").alias("Device"),
        F.expr("case o_orderkey % 10 when 0 then null when 1 then 'TEST100x' when 2 then 'Trial1' "
               "else 'SAVE' || o_orderkey % 3 end").alias("Order_Coupon"),
        F.expr("case o_custkey % 4 when 0 then 'code-batchA-' || o_custkey % 7 when 1 then 'code-other-' || o_custkey % 7 end")
        .alias("affiliate_code"),
        F.expr("cast(p_partkey % 90 + 10 as string) || '-' || p_partkey").alias("FinalShortSKU"),
        F.expr("case when o_orderkey % 3 = 0 then 'New' else 'Returning' end").alias("New_Returning"),
        F.col("l_quantity").alias("Item_Qty_Ordered"), F.col("l_extendedprice").alias("Item_Price"),
        net.alias("ItemRevenue"), (net * F.col("l_tax")).alias("Item_Tax"), F.col("o_totalprice").alias("Order_SubTotal"),
        (F.col("l_extendedprice") * F.col("l_discount") * 0.1).alias("Item_Gift_Certificate_Amount"))


def purchased_items(spark: SparkSession, sf: str) -> DataFrame:
    """Who bought which item when: four columns of ``order_items``. Line items meet their part first, while they are two numbers, and come grouped by order."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, sf, "part").select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.select("l_orderkey", "p_partkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("Order_Number"), F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int))").alias("Creation_Datetime"),
        F.expr(EMAIL).alias("customer_email"), F.expr("cast(p_partkey % 90 + 10 as string) || '-' || p_partkey").alias("FinalShortSKU"))


EMAIL = ("case when o_custkey % 97 = 5 then '' else case when o_custkey % 2 = 0 then 'U' else 'u' end "
         "|| o_custkey || '@x' end")
EYEWEAR = ("case p_size % 5 when 0 then 'Contact Lenses' when 1 then case when p_size % 2 = 0 then 'Accessories' "
           "else 'Product Upgrade' end else 'Eyeglasses' end")


# ---- e-mail

_MAIL = "case when user_id % 2 = 0 then 'U' else 'u' end || user_id || '@x'"
_NAME = "((day(ts) - 1) div 5 * 5 + 1) || '.' || month(ts) || '.24_c' || k % 4"


def _mail_events(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        "event_id", "ts", "user_id", "event_type", "value", "k", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"),
        F.expr(f"case when event_id % 50 <> 7 then {_MAIL} end").alias("email"), F.expr(_NAME).alias("message_name"),
        F.expr("'m' || k % 4").alias("msID"))


def message_activity_sent(spark: SparkSession, sf: str) -> DataFrame:
    return _mail_events(spark, sf).where("event_type = 'view'").select(
        "time", "email", F.lit("message-sent").alias("action"), "message_name", F.expr("'d' || k % 2").alias("mdtID"),
        "msID", F.expr("'e' || k % 2").alias("experiment"), F.expr("'v' || k % 3").alias("variant"),
        F.expr("case when k % 3 <> 0 then '[\"t' || k % 2 || '\"]' end").alias("mTags"))


def message_activity(spark: SparkSession, sf: str) -> DataFrame:
    return _mail_events(spark, sf).where("event_type in ('error', 'click', 'signup')").select(
        "time", "email", "message_name", "msID",
        F.expr("case event_type when 'error' then 'open' when 'click' then 'click' "
               "else case when k < 50 then 'optout' else 'bounce' end end").alias("action"),
        F.expr("case when k % 5 <> 0 then '/l/' || k % 5 end").alias("link"), F.expr("'n' || k % 5").alias("data_crdl_key"),
        F.expr("element_at(array('mobile','desktop'), k % 2 + 1)").alias("Device_type"), F.expr("'os' || k % 3").alias("Device_platform"))


def event_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order items of the event period: one item per purchase event."""
    return events(spark, sf).where("event_type = 'purchase'").select(
        F.col("event_id").alias("Order_Number"), F.col("ts").alias("Creation_Datetime"),
        F.expr("'u' || user_id || '@x'").alias("customer_email"),
        F.expr("case when k % 5 = 0 then 'Contact Lenses' else 'Eyeglasses' end").alias("EyewearType"),
        F.expr("case when k % 5 = 0 then 'Contact Lenses' else 'Frame' || k % 3 end").alias("FrameType"),
        F.expr("element_at(array('Progressive','Single Vision','Bifocal'), k % 3 + 1)").alias("LensType"),
        F.expr("case when k % 4 <> 0 then 'C' || k % 4 end").alias("Order_Coupon"), F.col("value").alias("ItemRevenue"),
        F.lit(1.0).alias("Item_Qty_Ordered"), F.expr("case when k % 3 = 0 then 'New' else 'Returning' end").alias("New_Returning"))


def event_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Click facts: delivered some hours before the click."""
    return _mail_events(spark, sf).where("event_type = 'click'").select(
        F.expr(_MAIL).alias("email"), F.expr("ts - make_dt_interval(0, k % 24)").alias("Sent_Datetime_PST"),
        F.col("ts").alias("click_Datetime_PST"), "message_name", F.expr("case when k % 5 <> 0 then '/l/' || k % 5 end").alias("linkUrl"),
        F.expr("'n' || k % 5").alias("linkname"), F.expr("element_at(array('mobile','desktop'), k % 2 + 1)").alias("Device"),
        F.expr("case when k % 3 <> 0 then '[\"t' || k % 2 || '\"]' else '[\"None\"]' end").alias("mTags"),
        F.expr("'o' || k % 2").alias("noOfOrders"))


def order_last_media(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).where("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("Order_id"),
        F.expr("element_at(array('Newsletter Other','Google Brand','cordial newsletter'), k % 3 + 1)").alias("media"))


def tz_offset(spark: SparkSession, sf: str) -> DataFrame:
    """Hours between UTC and three zones per date."""
    days = table(spark, sf, "events").select(F.to_date("ts").alias("Date")).distinct()
    pst = F.expr("case when day(Date) % 2 = 0 then -8 else -7 end")
    return days.select("Date", pst.alias("UTC_2_PST"), (pst + 3).alias("UTC_2_EST"), F.lit(2).alias("UTC_2_ILS"))


def legacy_inbound(spark: SparkSession, sf: str) -> DataFrame:
    return _mail_events(spark, sf).where("event_type in ('error', 'click', 'signup')").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm:ss.SSS").alias("createdTime"),
        F.expr("case when k % 6 = 0 then '' else date_format(ts - make_dt_interval(k % 5), \"yyyy-MM-dd'T'HH:mm:ss\") end").alias("deliveryStart"),
        F.expr("case event_type when 'error' then 'Open' when 'click' then 'Click' "
               "else case when k < 50 then 'unsubscribe' else 'bounce' end end").alias("activityType"),
        F.expr("case when k % 4 = 3 then 'PPS-contacts c' || k % 3 when k % 11 = 0 then '1.13.24_bad' else message_name end").alias("messageName"),
        F.expr(_MAIL).alias("emailAddress"), F.expr("'/l/' || k % 5").alias("linkUrl"), F.expr("'n' || k % 5").alias("linkName"),
        F.expr("'r' || k % 4").alias("bounceReason"))


def legacy_outbound(spark: SparkSession, sf: str) -> DataFrame:
    return _mail_events(spark, sf).where("event_type = 'view'").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.expr("case when k % 6 = 0 then '' else date_format(ts + make_dt_interval(k % 3 - 1), \"yyyy-MM-dd'T'HH:mm:ss\") end").alias("deliveryStart"),
        F.expr("element_at(array('bulk','Test','triggered'), k % 3 + 1)").alias("deliveryType"),
        F.col("message_name").alias("messageName"), F.expr(_MAIL).alias("emailAddress"))


def contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Base status of e-mail contacts: one row per customer address."""
    return table(spark, sf, "customer").where("c_custkey % 7 <> 3").select(
        F.expr("case when c_custkey % 2 = 0 then 'U' else 'u' end || c_custkey || '@x'").alias("channels_email_address"),
        F.expr("case when c_custkey % 3 = 0 then 'unsubscribed' else 'subscribed' end").alias("channels_email_subscribeStatus"),
        F.expr("case when c_custkey % 3 <> 0 then date_format(timestamp_ntz'1995-01-01 10:00:00' + make_dt_interval(cast(c_custkey % 900 as int)), 'yyyy-MM-dd HH:mm:ss') end").alias("channels_email_subinfo_ts"),
        F.expr("case when c_custkey % 3 = 0 then date_format(timestamp_ntz'1995-01-01 11:00:00' + make_dt_interval(cast(c_custkey % 900 as int)), 'yyyy-MM-dd HH:mm:ss') end").alias("channels_email_unsubinfo_ts"))


def contacts_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Status changes: one per order; status from the order status, time from the order date."""
    at = "date_format(o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int)), 'yyyy-MM-dd HH:mm:ss')"
    return table(spark, sf, "orders").where("o_custkey % 11 <> 2").select(
        F.expr("case when o_custkey % 2 = 0 then 'U' else 'u' end || o_custkey || '@x'").alias("channels_email_address"),
        F.expr("case o_orderstatus when 'O' then 'subscribed' when 'F' then 'unsubscribed' else 'none' end").alias("channels_email_subscribeStatus"),
        F.expr(f"case when o_orderstatus <> 'F' then {at} end").alias("channels_email_subinfo_ts"),
        F.expr(f"case when o_orderstatus = 'F' then {at} end").alias("channels_email_unsubinfo_ts"),
        F.col("o_orderdate").alias("ingest_ts"))


def order_tz_offset(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("Date")).distinct()
    return days.select("Date", F.expr("case when month(Date) between 4 and 10 then -7 else -8 end").alias("UTC_2_PST"))


def shop_subscribers(spark: SparkSession, sf: str) -> DataFrame:
    """Newsletter subscribers of the shop system: one row per order of most customers."""
    return table(spark, sf, "orders").where("o_custkey % 11 < 8").select(
        F.col("o_orderkey").alias("subscriber_id"), F.expr("'U' || o_custkey || '@x'").alias("subscriber_email"),
        F.expr("case when o_orderstatus = 'O' then 'SUBSCRIBED' else 'UNSUBSCRIBED' end").alias("status_name"),
        F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int))").alias("change_status_at"),
        F.expr("o_custkey % 9").alias("affiliate_id"))


def known_subscribers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").where("c_custkey % 5 = 0").select(
        F.expr("'u' || c_custkey || '@x'").alias("subscriber_email"),
        F.expr("timestamp_ntz'1995-02-01 08:00:00' + make_dt_interval(cast(c_custkey % 400 as int))").alias("Datetime_Created"))


def contact_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Contact-lens orders of the event period, numbered per customer."""
    lenses = event_orders(spark, sf).where("EyewearType = 'Contact Lenses'").select("customer_email", "Order_Number", "Creation_Datetime")
    return numbered(lenses, ["customer_email"], F.to_date("Creation_Datetime"),
                    [F.col("Creation_Datetime"), F.col("Order_Number")], "Rank")


# ---- partners

def partner_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Partner actions: all orders, some with a second, earlier click."""
    base = table(spark, sf, "orders").withColumn(
        "at", F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int))"))
    twice = base.withColumn("back", F.explode(F.expr("case when o_orderkey % 6 = 0 then array(0, 5) else array(0) end")))
    click = F.expr("date_format(at - make_dt_interval(cast(o_orderkey % 120 as int) + back), 'yyyy-MM-dd HH:mm:ss')")
    return twice.select(
        F.col("o_orderkey").cast("string").alias("oid"), F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("action_date"),
        F.expr("case o_orderkey % 10 when 0 then null when 1 then 'TEST100x' when 2 then 'Trial1' else 'SAVE' || o_orderkey % 3 end").alias("promo_code"),
        F.col("o_totalprice").alias("revenue"), click.alias("click_date"),
        F.expr("case left(o_orderpriority, 1) when '1' then ' Creators-A ' when '2' then 'creatorsgm-B' else 'Blog' end").alias("media"),
        F.lit(None).cast("string").alias("subid1"), F.lit("x").alias("subid2"), F.lit(None).cast("string").alias("subid3"),
        F.expr("case when o_custkey % 10 <> 9 then 'CH_' || o_custkey % 10 end").alias("subid4"))


def naming(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").where("s_suppkey % 8 <> 7").select(
        F.expr("case when s_suppkey % 8 <> 3 then ' Ch ' || s_suppkey || ' ' end").alias("Influence_Name"),
        F.expr("case s_suppkey when 0 then 'Creators-A' when 1 then 'creatorsgm-B' else 'Media ' || s_suppkey end").alias("IR_Media_Name"),
        F.expr("case when s_suppkey % 2 = 0 then 'code-batchA-' || s_suppkey % 7 end").alias("Affid"),
        F.expr("case when s_suppkey % 3 = 0 then 'med' || s_suppkey end").alias("D_name"), F.expr("'Mgr' || s_suppkey % 3").alias("AcctMgr"))
    return rows.distinct()


def affiliate_naming(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.expr("case when s_suppkey % 9 <> 4 then 'Partner ' || s_suppkey end").alias("Partner"), F.expr("'P' || s_suppkey").alias("IR_Partner_Name"),
        F.expr("case when s_suppkey % 2 = 0 then 'gm' || s_suppkey end").alias("GA_Medium"))


def affiliate_codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("entity_id"), F.expr("case when s_suppkey % 9 < 6 then 'code-batchA-' || s_suppkey else 'code-other-' || s_suppkey end").alias("code"))


def budget_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Planned budgets: supplier and month of the ship date, fee and month as text."""
    plan = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s"), F.trunc("l_shipdate", "MM").alias("m")).agg(
        F.round(F.sum("l_quantity"), 2).alias("Total_Budget"))
    live = "s % 3 <> 1"
    start = "date_add(m, cast(s % 20 as int))"
    return plan.select(
        F.expr("' Ch ' || s || ' '").alias("Channel_Name"), F.expr("case when s % 50 = 49 then 'LTB' when s % 10 = 8 then 'Blog' else 'Influencers' end").alias("Type"),
        F.expr("case when s % 17 = 3 and month(m) = 2 then 'Febuary' else date_format(m, 'MMMM') end").alias("Planned_Month"),
        F.date_format("m", "yyyy").alias("Planned_Year"), "Total_Budget", F.expr(f"case when {live} then 'Live' else 'pending' end").alias("Status"),
        F.expr(f"case when {live} then date_format({start}, 'yyyy-MM-dd') else 'tbd later on' end").alias("Timeline"),
        F.expr(f"case when {live} then ' ' || date_format({start}, 'd.M.yy') else 'tbd later on' end").alias("Timeline_text"),
        F.expr(f"case when {live} then date_format({start}, 'yyyy-MM-dd') end").alias("Live_date"),
        F.expr("'$' || format_number(Total_Budget, 2)").alias("Budget_text"),
        F.expr("'Mgr' || s % 3").alias("Acct__Mgr_"), F.expr("element_at(array('Flat fee','Flat + RevSh','Commission','to do'), cast(s % 4 + 1 as int))").alias("Fee"))


def funnel_spend(spark: SparkSession, sf: str) -> DataFrame:
    """Spend export rows: line items by ship date."""
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    return li.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.to_date("l_shipdate").alias("Date"), F.expr("'P' || l_suppkey % 3").alias("traffic_source"),
        F.expr("case when l_suppkey % 2 = 0 then 'Acquisition' else 'Retention' end").alias("Marketing_Channel"),
        F.expr("element_at(array('Mail','Search','Social','Liveintent','Video',null), cast(l_suppkey % 6 + 1 as int))").alias("Media"),
        F.expr("element_at(array('Glasses','Contacts','Sun'), p_size % 3 + 1)").alias("Product"),
        F.expr("element_at(array('Desktop','Mobile'), l_linenumber % 2 + 1)").alias("Device"), F.expr("'c' || l_suppkey").alias("campaign"),
        F.col("l_extendedprice").alias("cost"), F.col("l_quantity").alias("conversions"), (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("revenue"),
        F.expr("'Media ' || l_suppkey").alias("impact_media"), F.expr("case when l_linenumber <> 1 then 'Action' end").alias("impact_type"),
        F.expr("round(l_extendedprice * l_discount, 4)").alias("impact_action_cost"), F.col("l_suppkey").alias("suppkey"))


# ---- spend and ads

def main_spend(spark: SparkSession, sf: str) -> DataFrame:
    """Main spend export; suppliers with a key divisible by five are only in the campaign export."""
    return funnel_spend(spark, sf).where("suppkey % 5 <> 0").drop("suppkey")


def campaign_spend(spark: SparkSession, sf: str) -> DataFrame:
    """Campaign-level export: suppliers with an odd key or one divisible by ten, so that each supplier is in an export."""
    return table(spark, sf, "lineitem").where("l_suppkey % 2 = 1 or l_suppkey % 10 = 0").select(
        F.to_date("l_shipdate").alias("Date"), F.expr("element_at(array('Desktop','Mobile'), l_linenumber % 2 + 1)").alias("Device"),
        F.expr("'c' || l_suppkey").alias("campaign"), F.expr("case when l_suppkey % 3 = 0 then 77L end").alias("account"),
        F.col("l_extendedprice").alias("cost"), F.col("l_quantity").alias("conversions"), F.expr("l_extendedprice * 2").alias("value"))


def spend_media_reference(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.lit("Google").alias("source"), F.expr("case when s_suppkey % 4 = 1 then 'CPC' else 'cpc' end").alias("medium"), F.expr("'C' || s_suppkey").alias("campaign"),
        F.expr("case when s_suppkey % 3 = 0 then 77L end").alias("adwords_account"), F.expr("'G ' || s_suppkey % 4").alias("Media"))


def spend_media_type(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([("G 0", "Google", "Glasses"), ("G 1", "Google", "Contact Lenses"), ("G 3", "YouTube", "Sun")],
                                 "Media string, Platform string, Product_Type string")


def partner_spend(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where("l_suppkey % 7 = 2").select(
        F.date_add("l_shipdate", 100).alias("Date"), F.col("l_extendedprice").alias("spent"), F.col("l_quantity").alias("conversions"), F.expr("l_extendedprice * 3").alias("revenue"))


def manual_spend(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.expr("case when s_suppkey % 6 <> 5 then date_add(date'2001-01-01', cast(s_suppkey % 30 as int)) end").alias("Date"), F.lit("2001-11-04").cast("date").alias("Max_Date"),
        F.lit("TV").alias("Platform"), F.lit("Acquisition").alias("Marketing_Channel"), F.lit("TV").alias("Media"), F.lit("Glasses").alias("Product_Group"),
        F.lit("Desktop").alias("Device"), F.col("s_acctbal").alias("Spend"), F.lit(0.0).alias("Conversions"), F.lit(0.0).alias("Conversion_Revenue"))


def _ads(li: DataFrame) -> DataFrame:
    return li.select(
        F.to_date("l_shipdate").alias("Date"), F.date_format("l_shipdate", "yyyyMM").alias("shard"), F.expr("cast(l_suppkey as string)").alias("Campaign_ID"),
        F.expr("'c' || l_suppkey").alias("Campaign_Name"), F.expr("'g' || l_suppkey || '_' || l_linenumber").alias("Ad_Group_ID"), F.expr("'Group ' || l_linenumber").alias("Ad_Group_Name"),
        F.expr("'a' || l_partkey").alias("Ad_ID"), F.expr("'Ad ' || l_partkey").alias("Ad_Name"), F.expr("case when l_linenumber % 2 = 0 then 'Search' else 'Shopping' end").alias("Ad_group_type"),
        F.expr("element_at(array('Desktop','Mobile'), l_linenumber % 2 + 1)").alias("Device"), F.expr("case when l_partkey % 10 <> 3 then 'Ad Level' else 'Other' end").alias("Connection_Name"),
        F.expr("cast(l_quantity * 10 as bigint)").alias("Impressions"), F.expr("cast(l_quantity * 4 as bigint)").alias("Top"), F.expr("cast(l_quantity as bigint)").alias("Absolute_Top"),
        F.expr("cast(l_quantity as bigint)").alias("Clicks"), F.col("l_extendedprice").alias("Cost"), F.expr("case when l_linenumber % 3 = 0 then l_quantity else 0.0 end").alias("Conversions"),
        F.expr("l_extendedprice * 2").alias("Value"), F.expr("cast(l_orderkey % 3 as bigint)").alias("Leads"), F.expr("cast(l_orderkey % 2 as bigint)").alias("ATC"),
        F.expr("cast(l_partkey % 4 as bigint)").alias("New_Customers"))


def ad_export(spark: SparkSession, sf: str) -> DataFrame:
    return _ads(table(spark, sf, "lineitem").where("l_suppkey % 5 <> 0")).withColumn("Date", F.col("Date").cast("string"))


def campaign_export(spark: SparkSession, sf: str) -> DataFrame:
    return _ads(table(spark, sf, "lineitem").where("l_suppkey % 2 = 1 or l_suppkey % 10 = 0")).drop(
        "Ad_ID", "Ad_Name", "Ad_Group_ID", "Ad_Group_Name", "Ad_group_type", "Connection_Name", "New_Customers")


# ---- search

def search_rows(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.to_date("l_shipdate").alias("Date"), F.date_format("l_shipdate", "yyyyMM").alias("shard"), F.expr("element_at(array('Desktop','Mobile'), l_linenumber % 2 + 1)").alias("Device"),
        F.col("p_name").alias("Query"), F.expr("'/q/' || l_partkey % 50").alias("Page"), F.expr("case when l_suppkey % 3 <> 0 then 'usa' else 'can' end").alias("Country"),
        F.expr("cast(l_quantity / 3 as bigint)").alias("Impressions"), F.expr("cast(case when l_orderkey % 9 = 0 then 1 else 0 end as bigint)").alias("Clicks"),
        F.expr("l_quantity * 1.5D").alias("Total_Position"))


def keyword_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.expr("case when p_size < 10 then p_name end").alias("Keyword"))


def paid_search(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date"), F.col("p_name").alias("Search_Term"), F.expr("element_at(array('Desktop','Mobile'), l_linenumber % 2 + 1)").alias("Device"),
        F.expr("l_extendedprice * (l_suppkey % 2)").alias("Cost"), F.expr("cast(l_quantity * 7 as bigint)").alias("Impressions"), F.expr("cast(l_quantity as bigint)").alias("Clicks"),
        F.expr("case when l_suppkey % 4 = 0 then l_quantity else 0.0 end").alias("Conversions"), F.expr("l_extendedprice * 2").alias("Value"))


# ---- alerts and feeds

def live_orders(spark: SparkSession, sf: str, bucket: int) -> DataFrame:
    """Orders as they come in; amounts are rounded down to a bucket so that they repeat."""
    return table(spark, sf, "orders").select(
        F.expr("'visitor' || o_custkey").alias("visitor_id"), F.expr("cast(o_orderkey as string)").alias("increment_id"),
        F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int))").alias("created_at"), (F.floor(F.col("o_totalprice") / bucket) * float(bucket)).alias("revenue"))


def app_visitors(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return table(spark, sf, "customer").where("c_custkey % 6 <> 1").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.expr("'visitor' || c_custkey").alias("visitor_id"), F.expr("'p' || c_custkey").alias("user_pseudo_id"), "country")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    # what is made of one column of a line is made before the join, where it is smaller
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", F.expr("cast(l_quantity % 5 + 1 as int)").alias("overall"), F.expr("nullif(cast(l_suppkey % 5 as int), 0)").alias("style"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.expr("(l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey").alias("id"), F.expr("'Nick ' || o_custkey").alias("nickname"), F.col("o_custkey").alias("author_id"),
        F.expr("l_shipdate + make_dt_interval(0, cast(l_partkey % 24 as int), 7, 9)").alias("created_at"), F.expr("'T' || l_linenumber").alias("title"), F.expr("'Text ' || l_partkey").alias("detail"),
        "overall", F.expr("l_linenumber % 2 = 0").alias("recommend"), F.expr("nullif(cast(l_partkey % 4 as int), 0)").alias("fit"),
        "style", F.expr("nullif(cast(l_orderkey % 4 as int), 0)").alias("quality"),
        F.expr("case when l_linenumber % 3 <> 0 then 1 else 2 end").alias("status_id"), F.col("l_partkey").alias("product_id"))


def review_authors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.expr("case when c_custkey % 97 = 5 then null else 'U' || c_custkey || '@X' end").alias("email"))


_SKU = "cast(p_partkey % 90 + 10 as string) || '-' || p_partkey"


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.expr(_SKU).alias("sku"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.expr("'Full ' || p_type").alias("frame_type"),
        F.expr("case p_size % 3 when 0 then 'Eyeglasses' when 1 then 'Sunglasses' end").alias("eyewear_type"), F.expr("case when p_size % 4 = 0 then 'No' else 'Yes' end").alias("eligible_for_rx_lenses"),
        F.expr("case when p_size % 6 = 0 then 'DSCO' else 'L' || p_size % 2 end").alias("extlab_id"))


def gtins(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where("p_partkey % 3 = 0").select(F.expr(_SKU).alias("sku"), F.expr("'0' || p_partkey * 7").alias("UPC"))


def mpns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where("p_partkey % 4 = 0").select(F.expr(_SKU).alias("id"), F.expr("'M' || p_partkey").alias("MPN"))


def stock(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.expr(_SKU).alias("sku"), F.expr("'  ' || upper(left(p_name, 1)) || substring(p_name, 2) || case p_size % 4 when 0 then ' Red' when 1 then ' w/ Gold/Black' when 2 then ' Kids' else ' Old Label' end")
        .alias("name"), F.expr("element_at(array('Red','Shiny Black , Gold','Blue Green','Matte Very Dark Old Grey Tone'), p_size % 4 + 1)").alias("color"),
        F.expr("case when p_size % 3 = 0 then 'Oval , Square' else 'Round' end").alias("shape"), F.expr("case when p_size % 5 = 0 then null else p_brand end").alias("brand"),
        F.expr("element_at(array('119,3','159','7'), p_size % 3 + 1)").alias("category_ids"), F.expr("'item-' || p_partkey").alias("url_key"),
        F.expr("case when p_size % 7 <> 0 then '/x/' || p_size || '/f' || p_partkey || '.jpg' else '' end").alias("front_image"), F.expr("case when p_size % 2 = 0 then '/s' || p_partkey || '.jpg' end").alias("side_image"),
        F.expr("case when p_size % 3 = 0 then '/g' || p_partkey || '.jpg' else '' end").alias("angle_image"), F.expr("element_at(array('Medium','Toddlers','Large'), p_size % 3 + 1)").alias("frame_size"),
        F.expr("element_at(array('Men','Women','Girls','None'), p_size % 4 + 1)").alias("gender"), F.expr("case p_size % 4 when 0 then 'Big Special Sale' when 1 then '' when 2 then 'Lux' end").alias("product_badge"),
        F.expr("'Mat ' || p_size % 3").alias("framematerial"), F.expr("cast(p_size % 9 as string)").alias("qty"), F.expr("cast(p_retailprice as string)").alias("price"),
        F.expr("cast(p_retailprice - 10.5D as string)").alias("final_price"))


def stock_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.expr(_SKU).alias("Unique_ID"), F.expr("' ' || lower(p_type) || ' frames '").alias("Keyword"),
                                           F.expr("cast(p_partkey % 90 + 10 as string) || '-'").alias("SKU_Prefix"), F.expr("'face ' || p_size % 3").alias("face_shape"))


def price_fixes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where("p_partkey % 10 = 0").select(F.expr("upper(" + _SKU + ")").alias("sku"), F.lit("99.99").alias("Price"), F.lit("89.5").alias("Final_Price"))


def promo_rules(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where("p_brand in ('Brand#1', 'Brand#2', 'Brand#3')").select(F.col("p_brand").alias("brand"), F.expr("'SAVE' || right(p_brand, 1)").alias("promo_code"),
                                                                                          F.lit(0.25).alias("discount")).distinct()
