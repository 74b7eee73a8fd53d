"""Spend, ads, search, alert and feed queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..operators import alerts, feeds, search, spend
from ..sources import adapters as A
from ..sources.targets import overwrite, reload_window, stage
from . import sqltext as S
from .registry import query

AS_OF, SINCE = date(2001, 11, 5), date(1995, 6, 1)

MAIN = """fu AS (SELECT CAST(l_shipdate AS DATE) AS Date, 'P' || l_suppkey % 3 AS Platform, CASE WHEN l_suppkey % 2 = 0 THEN 'Acquisition' ELSE 'Retention' END AS Marketing_Channel,
      ['Mail','Search','Social','Liveintent','Video',NULL][l_suppkey % 6 + 1] AS Media, ['Glasses','Contacts','Sun'][p_size % 3 + 1] AS Product_Group, ['Desktop','Mobile'][l_linenumber % 2 + 1] AS Device,
      'c' || l_suppkey AS campaign, l_extendedprice AS cost, l_quantity AS conv, l_extendedprice * (1 + l_tax) AS rev FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 5 <> 0)"""
MONEY = "round(sum(cost), 2) AS Spend, sum(conv) AS Conversions, round(sum(rev), 4) AS Conversion_Revenue"
PART1 = f"""SELECT Date, Platform, Marketing_Channel, Media, Product_Group, Device, {MONEY} FROM fu WHERE Date BETWEEN DATE '1995-06-01' AND DATE '2001-11-04' AND Media NOT IN ('Mail', 'Impact')
      AND campaign NOT IN ('c7', 'c11') GROUP BY ALL"""
PART2 = """SELECT Date, Platform, 'Acquisition', Media, CASE WHEN pt LIKE '%Contact%' THEN 'Contacts' ELSE pt END, Device, round(sum(l_extendedprice), 2), sum(l_quantity), round(sum(l_extendedprice * 2), 4)
      FROM (SELECT CAST(l_shipdate AS DATE) AS Date, ['Desktop','Mobile'][l_linenumber % 2 + 1] AS Device, l_extendedprice, l_quantity, t.* FROM lineitem
        JOIN (VALUES (0, 'G 0', 'Google', 'Glasses'), (1, 'G 1', 'Google', 'Contact Lenses'), (3, 'G 3', 'YouTube', 'Sun')) t(k, Media, Platform, pt) ON l_suppkey % 4 = k
        WHERE (l_suppkey % 2 = 1 OR l_suppkey % 10 = 0) AND 'c' || l_suppkey NOT IN (SELECT campaign FROM fu)) GROUP BY ALL"""
PART3 = """SELECT Date, 'LiveIntent', 'Acquisition', 'Liveintent', 'Glasses', 'Desktop', round(sum(l_extendedprice), 2), sum(l_quantity), round(sum(l_extendedprice * 3), 4)
      FROM (SELECT CAST(l_shipdate AS DATE) + 100 AS Date, * FROM lineitem WHERE l_suppkey % 7 = 2) WHERE Date >= DATE '1999-01-01'
        AND Date NOT IN (SELECT Date FROM fu WHERE Media = 'Liveintent' AND Date >= DATE '1999-01-01') GROUP BY ALL"""
MANUAL = """SELECT CAST(DATE '2001-01-01' + CAST(s_suppkey % 30 AS INTEGER) AS DATE) AS Date, 'TV' AS Platform, 'Acquisition' AS Marketing_Channel, 'TV' AS Media, 'Glasses' AS Product_Group, 'Desktop' AS Device, s_acctbal AS Spend, 0.0::DOUBLE AS Conversions, 0.0::DOUBLE AS Conversion_Revenue
      FROM supplier WHERE s_suppkey % 6 <> 5"""


def spend_sql(extra: str) -> str:
    return f"WITH {MAIN} SELECT *, DATE '2001-11-04' AS Max_Date FROM ({PART1} {extra} UNION ALL {PART3} UNION ALL {MANUAL})"


def spent(spark, sf, **more):
    excluded = spark.createDataFrame([("c7",), ("c11",)], "Media string")
    main = A.main_spend(spark, sf)
    out = spend.spend_union(main, ["Mail", "Impact"], excluded, A.partner_spend(spark, sf), ("LiveIntent", "Liveintent"), A.manual_spend(spark, sf), AS_OF, SINCE, date(1999, 1, 1), **more)
    return out.withColumn("Spend", F.round("Spend", 2)).withColumn("Conversion_Revenue", F.round("Conversion_Revenue", 4))


@query("spend_union", spend_sql("UNION ALL " + PART2))
def spend_union(spark, sf):
    return spent(spark, sf, campaigns=A.campaign_spend(spark, sf), media_ref=A.spend_media_reference(spark, sf), media_types=A.spend_media_type(spark, sf))


@query("spend_union_without_campaigns", spend_sql(""))
def spend_union_without_campaigns(spark, sf):
    return spent(spark, sf)


WINDOW = "CAST(l_shipdate AS DATE) BETWEEN DATE '2000-11-05' AND DATE '2001-11-04'"
LISTED = "l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey % 5 <> 0 AND strftime(l_shipdate, '%Y%m') BETWEEN '200011' AND '200111')"
CONV = "CASE WHEN l_linenumber % 3 = 0 THEN l_quantity ELSE 0.0 END"
DEVICE = "['Desktop','Mobile'][l_linenumber % 2 + 1] AS Device"


@query("ads_cohort_snapshot", f"""SELECT DATE '2001-11-04' AS Cohort_Date, CAST(l_shipdate AS DATE) AS Date, CAST(l_suppkey AS VARCHAR) AS Campaign_ID, 'g' || l_suppkey || '_' || l_linenumber AS Ad_Group_ID, 'a' || l_partkey AS Ad_ID, {DEVICE},
      CAST(sum(l_orderkey % 3) AS BIGINT) AS Leads, CAST(sum(l_orderkey % 2) AS BIGINT) AS ATC, CAST(sum(l_partkey % 4) AS BIGINT) AS New_Customer_Conversions, CAST(sum({CONV}) AS DOUBLE) AS Conversions, round(sum(l_extendedprice * 2), 4) AS Conversion_Value
      FROM lineitem WHERE l_suppkey % 5 <> 0 AND l_partkey % 10 <> 3 AND {WINDOW} AND ({CONV} > 0 OR l_orderkey % 3 > 0 OR l_orderkey % 2 > 0 OR l_partkey % 4 > 0) GROUP BY ALL
    UNION ALL SELECT DATE '2001-11-04', CAST(l_shipdate AS DATE), CAST(l_suppkey AS VARCHAR), NULL, NULL, {DEVICE}, CAST(sum(l_orderkey % 3) AS BIGINT), CAST(sum(l_orderkey % 2) AS BIGINT), NULL, CAST(sum({CONV}) AS DOUBLE), round(sum(l_extendedprice * 2), 4)
      FROM lineitem WHERE (l_suppkey % 2 = 1 OR l_suppkey % 10 = 0) AND {LISTED} AND {WINDOW} AND ({CONV} > 0 OR l_orderkey % 3 > 0 OR l_orderkey % 2 > 0) GROUP BY ALL""")
def ads_cohort_snapshot(spark, sf):
    out = spend.ads_snapshot(A.ad_export(spark, sf), A.campaign_export(spark, sf), AS_OF, "Ad Level", 365)
    return out.withColumn("Conversion_Value", F.round("Conversion_Value", 4))


FINAL = "CAST(sum(CAST(l_quantity * 10 AS BIGINT)) AS BIGINT) AS impressions, CAST(sum(CAST(l_quantity * 4 AS BIGINT)) AS BIGINT) AS top_impressions, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS absolute_top_impressions, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Clicks, round(sum(l_extendedprice), 2) AS Spend, CAST(sum(" + CONV + ") AS DOUBLE) AS Conv, round(sum(l_extendedprice * 2), 4) AS Conv_Value"


@query("ads_final_reload", f"""WITH n AS (SELECT CAST(l_shipdate AS DATE) AS Date, CAST(l_suppkey AS VARCHAR) AS Campaign_ID, 'c' || l_suppkey AS Campaign_Name, 'a' || l_partkey AS Ad_ID, 'Ad ' || l_partkey AS Ad_Name, 'g' || l_suppkey || '_' || l_linenumber AS Ad_Group_ID,
      'Group ' || l_linenumber AS Ad_Group_Name, CASE WHEN l_linenumber % 2 = 0 THEN 'Search' ELSE 'Shopping' END AS Ad_group_type, {DEVICE}, {FINAL} FROM lineitem WHERE l_suppkey % 5 <> 0 AND l_partkey % 10 <> 3 AND {WINDOW} GROUP BY ALL
    UNION ALL SELECT CAST(l_shipdate AS DATE), CAST(l_suppkey AS VARCHAR), 'c' || l_suppkey, NULL, NULL, NULL, NULL, NULL, {DEVICE}, {FINAL} FROM lineitem WHERE (l_suppkey % 2 = 1 OR l_suppkey % 10 = 0) AND {LISTED} AND {WINDOW} GROUP BY ALL)
    SELECT * FROM n WHERE Date >= DATE '2001-01-01' UNION ALL SELECT * REPLACE (-1.0::DOUBLE AS Spend) FROM n WHERE Date < DATE '2001-01-01'""")
def ads_final_reload(spark, sf):
    rows = spend.ads_final(A.ad_export(spark, sf), A.campaign_export(spark, sf), AS_OF, "Ad Level", 365)
    rows = stage(rows.withColumn("Spend", F.round("Spend", 2)).withColumn("Conv_Value", F.round("Conv_Value", 4)))
    cutoff = date(2001, 1, 1)
    return reload_window(rows.withColumn("Spend", F.lit(-1.0)), rows.where(F.col("Date") >= F.lit(cutoff)), "Date", cutoff)


BRAND, NOT_BRAND = ["red wid", "small r", "big"], ["red widget x", "big ring"]
CLASS = """CASE WHEN ({0} LIKE '%red wid%' OR {0} LIKE '%small r%' OR {0} LIKE '%big%') AND {0} NOT LIKE '%red widget x%' AND {0} NOT LIKE '%big ring%' THEN 'Brand'
    WHEN {0} IN (SELECT p_name FROM part WHERE p_size < 10) THEN 'Top Industry Keyword' ELSE 'Other' END"""


def report_sql(limit: int, page: str) -> str:
    return f"""SELECT CAST(l_shipdate AS DATE) AS Date, {DEVICE}, p_name AS Query, {CLASS.format('p_name')} AS Category, {page} CAST(floor(l_quantity / 3) AS BIGINT) AS Impressions,
      CAST(CASE WHEN l_orderkey % 9 = 0 THEN 1 ELSE 0 END AS BIGINT) AS Clicks, l_quantity * 1.5 AS Total_Position FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE l_suppkey % 3 <> 0 AND (floor(l_quantity / 3) >= {limit} OR l_orderkey % 9 = 0)"""


@query("search_query_report", f"""WITH n AS ({report_sql(10, '')}) SELECT * FROM n WHERE Date >= DATE '2000-01-01' UNION ALL SELECT * REPLACE ('old' AS Category) FROM n WHERE Date < DATE '2000-01-01'""")
def search_query_report(spark, sf):
    rows = search.search_report(A.search_rows(spark, sf), A.keyword_sheet(spark, sf), 10, BRAND, NOT_BRAND)
    cutoff = date(2000, 1, 1)
    return reload_window(rows.withColumn("Category", F.lit("old")), rows.where(F.col("Date") >= F.lit(cutoff)), "Date", cutoff)


@query("search_page_report", report_sql(5, "'/q/' || l_partkey % 50 AS Page,"))
def search_page_report(spark, sf):
    return search.search_report(A.search_rows(spark, sf), A.keyword_sheet(spark, sf), 5, BRAND, NOT_BRAND, date(1995, 1, 1), date(2001, 12, 31), page=True)


@query("keyword_refresh", "SELECT p_name AS Keyword FROM part WHERE p_size < 10")
def keyword_refresh(spark, sf):
    sheet = A.keyword_sheet(spark, sf)
    return overwrite(sheet, search.keyword_refresh(sheet))


@query("classify_query", f"SELECT p_partkey, p_name AS Query, {CLASS.format('p_name')} AS Category FROM part")
def classify_query(spark, sf):
    keys = A.keyword_sheet(spark, sf).where("Keyword is not null").distinct()
    part = A.table(spark, sf, "part")
    return part.join(keys, part.p_name == keys.Keyword, "left").select(
        "p_partkey", F.col("p_name").alias("Query"), search.classify_query(F.col("p_name"), F.col("Keyword"), BRAND, NOT_BRAND).alias("Category"))


@query("organic_paid", f"""WITH o AS ({report_sql(10, '')}), a AS (SELECT CAST(l_shipdate AS DATE) AS Date, p_name AS Query, {DEVICE}, round(sum(l_extendedprice * (l_suppkey % 2)), 2) AS Paid_Cost, CAST(sum(CAST(l_quantity * 7 AS BIGINT)) AS BIGINT) AS Paid_Impressions,
      CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Paid_Clicks, CAST(sum(CASE WHEN l_suppkey % 4 = 0 THEN l_quantity ELSE 0.0 END) AS DOUBLE) AS Paid_Conversions, round(sum(l_extendedprice * 2), 2) AS Paid_Conversions_Value
      FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 2 = 1 OR l_suppkey % 4 = 0 GROUP BY ALL) SELECT * FROM o LEFT JOIN a USING (Date, Device, Query)""")
def organic_paid(spark, sf):
    organic = search.search_report(A.search_rows(spark, sf), A.keyword_sheet(spark, sf), 10, BRAND, NOT_BRAND)
    out = search.organic_paid(organic, A.paid_search(spark, sf))
    return out.withColumns({c: F.round(c, 2) for c in ("Paid_Cost", "Paid_Conversions_Value")})


def live_sql(bucket: int, days: int) -> str:
    return f"""lo AS (SELECT 'visitor' || o_custkey AS visitor_id, CAST(o_orderkey AS VARCHAR) AS oid, o_orderdate + to_minutes(o_orderkey % 1440) AS created_at, floor(o_totalprice / {bucket}) * {bucket} AS revenue FROM orders),
    la AS (SELECT * FROM lo WHERE created_at >= (SELECT max(created_at) FROM lo) - INTERVAL {days} DAY),
    av AS (SELECT 'visitor' || c_custkey AS visitor_id, 'p' || c_custkey AS user_pseudo_id, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 6 <> 1)"""


SPREAD = "date_diff('minute', min(created_at), max(created_at)) AS first_to_last"
PST = "timezone('America/Los_Angeles', timezone('UTC', created_at)) AS PST_date"


def excluded(spark):
    return spark.createDataFrame([("NATION_3",), ("NATION_7",)], "country string")


@query("alert_repeat_orders", f"""WITH {live_sql(250000, 400)} SELECT DISTINCT la.visitor_id, {PST}, oid, user_pseudo_id, country, first_to_last FROM la LEFT JOIN av USING (visitor_id)
    JOIN (SELECT visitor_id, {SPREAD} FROM la GROUP BY 1 HAVING count(DISTINCT oid) > 2 AND count(DISTINCT revenue) = 1) g USING (visitor_id) WHERE length(la.visitor_id) > 5 AND (country IS NULL OR country NOT IN ('NATION_3', 'NATION_7'))""")
def alert_repeat_orders(spark, sf):
    return alerts.alert_repeat(A.live_orders(spark, sf, 250000), A.app_visitors(spark, sf), excluded(spark), 400 * 1440)


@query("alert_same_amount", f"""WITH {live_sql(500, 60)} SELECT DISTINCT la.visitor_id, {PST}, oid, revenue, user_pseudo_id, country, first_to_last FROM la LEFT JOIN av USING (visitor_id)
    JOIN (SELECT revenue, {SPREAD} FROM la GROUP BY 1 HAVING count(DISTINCT oid) > 2) g USING (revenue) WHERE true AND (country IS NULL OR country NOT IN ('NATION_3', 'NATION_7'))""")
def alert_same_amount(spark, sf):
    return alerts.alert_amount(A.live_orders(spark, sf, 500), A.app_visitors(spark, sf), excluded(spark), 60 * 1440)


@query("order_revenue", f"""WITH {S.ITEMS} SELECT Order_Number, Order_SubTotal, CAST(Creation_Datetime AS DATE) AS Date, round(sum(ItemRevenue), 4) AS Revenue, round(sum(ItemRevenue + Item_Gift_Certificate_Amount), 6) AS Revenue_with_GC
    FROM items WHERE Creation_Datetime BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-06-01' GROUP BY ALL""")
def order_revenue(spark, sf):
    out = feeds.order_revenue(A.order_items(spark, sf), datetime(1995, 1, 1), datetime(2001, 6, 1))
    return out.withColumn("Revenue", F.round("Revenue", 4)).withColumn("Revenue_with_GC", F.round("Revenue_with_GC", 6))


SKU = "CAST(p_partkey % 90 + 10 AS VARCHAR) || '-' || p_partkey"
SPAN = """SELECT *, coalesce(lag(ts) OVER w, ts - INTERVAL 1 YEAR) AS prev, coalesce(lead(ts) OVER w, ts + INTERVAL 1 YEAR) AS post"""


@query("review_feed", f"""WITH {S.ITEMS}, r AS (SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS review_id, o_custkey, l_partkey, l_linenumber, l_suppkey, l_orderkey, l_quantity, l_shipdate + to_hours(l_partkey % 24) + INTERVAL 7 MINUTE + INTERVAL 9 SECOND AS utc,
      CASE WHEN o_custkey % 97 <> 5 THEN 'u' || o_custkey || '@x' END AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber % 3 <> 0),
    rl AS (SELECT r.*, timezone('America/Los_Angeles', timezone('UTC', utc)) AS loc, p_name, p_brand, {SKU} AS sku, p_partkey FROM r JOIN part ON l_partkey = p_partkey),
    o1 AS ({SPAN} FROM (SELECT lower(customer_email) AS oe, FinalShortSKU AS osku, Creation_Datetime AS ts, Order_Number FROM items) WINDOW w AS (PARTITION BY oe, osku ORDER BY ts, Order_Number)),
    o2 AS ({SPAN} FROM (SELECT DISTINCT lower(customer_email) AS oe, Creation_Datetime AS ts, Order_Number FROM items) WINDOW w AS (PARTITION BY oe ORDER BY ts, Order_Number))
    SELECT DISTINCT review_id, 'Nick ' || o_custkey AS reviewer_name, o_custkey AS reviewer_id, strftime(utc, '%Y-%m-%dT%H:%M:%S') || '-0' || date_diff('hour', loc, utc) || ':00' AS review_timestamp, 'T' || l_linenumber AS title, 'Text ' || l_partkey AS content,
      'https://shop.example/item-' || p_partkey || '.html' AS review_url, 1 AS min, 5 AS max, CAST(l_quantity % 5 + 1 AS INTEGER) AS overall, sku, p_brand AS brand, CASE WHEN p_partkey % 3 = 0 THEN '0' || p_partkey * 7 END AS gtin,
      CASE WHEN p_partkey % 4 = 0 THEN 'M' || p_partkey END AS mpn, p_name AS product_name, 'https://shop.example/item-' || p_partkey || '.html' AS product_url, 'false' AS is_spam, 'post_fulfillment' AS collection_method,
      coalesce(o1.Order_Number, o2.Order_Number) AS transaction_id,
      ltrim(CASE WHEN l_linenumber % 2 = 0 THEN 'Would recommend to others' ELSE '' END || CASE WHEN l_partkey % 4 = 2 THEN ',True to size' ELSE '' END
        || CASE l_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN ',Chic style' WHEN 2 THEN ',Vintage style' WHEN 3 THEN ',Classic style' END || CASE WHEN l_orderkey % 4 = 3 THEN ',High Quality' ELSE '' END, ',') AS pros,
      ltrim(CASE l_partkey % 4 WHEN 1 THEN ',Loose fit' WHEN 3 THEN ',Tight fit' ELSE '' END || CASE WHEN l_orderkey % 4 = 1 THEN ',Low Quality' ELSE '' END, ',') AS cons
    FROM rl LEFT JOIN o1 ON e = o1.oe AND sku = osku AND loc BETWEEN o1.prev AND o1.post LEFT JOIN o2 ON e = o2.oe AND loc BETWEEN o2.prev AND o2.post""")
def review_feed(spark, sf):
    return feeds.review_feed(A.reviews(spark, sf), A.review_authors(spark, sf), A.inventory(spark, sf), A.gtins(spark, sf), A.mpns(spark, sf), A.stock(spark, sf), A.purchased_items(spark, sf),
                             "https://shop.example/")


NAME = "'  ' || upper(left(p_name, 1)) || substr(p_name, 2) || CASE p_size % 4 WHEN 0 THEN ' Red' WHEN 1 THEN ' w/ Gold/Black' WHEN 2 THEN ' Kids' ELSE ' Old Label' END"
TITLE = "replace(trim(name), 'Old Label', 'Label Old')"
BARE = """trim(replace(replace(replace(replace(replace(replace(list_reduce(list_prepend({0}, list_reverse(words)), lambda a, w: replace(a, w, '')),
      replace(color, ' , ', ' '), ''), 'w/', ''), '/', ''), ',', ''), '   ', ' '), '  ', ' '))""".format(TITLE)
NUM = "regexp_replace(CAST(round({0}, 2) AS VARCHAR), '\\.0$', '')"
RX = "CASE WHEN lower(kind) = 'eyeglasses' THEN 'Eyeglasses' WHEN p_size % 4 = 0 THEN 'Sunglasses (Non-RX)' ELSE 'Sunglasses (RX-able)' END"
IMG = "https://img.example"


@query("product_feed", f"""WITH s AS (SELECT *, {SKU} AS sku, {NAME} AS name, ['Red','Shiny Black , Gold','Blue Green','Matte Very Dark Old Grey Tone'][p_size % 4 + 1] AS color, CASE WHEN p_size % 3 = 0 THEN 'Oval' ELSE 'Round' END AS shape1,
      CASE WHEN p_size % 3 = 0 THEN 'Oval , Square' ELSE 'Round' END AS shape, coalesce(['Eyeglasses','Sunglasses',NULL][p_size % 3 + 1], 'Eyeglasses') AS kind, lower(p_type) || ' frames' AS kw, ['Medium','Toddlers','Large'][p_size % 3 + 1] AS fs,
      CASE WHEN p_partkey % 10 = 0 THEN 99.99 ELSE p_retailprice END AS pr, CASE WHEN p_partkey % 10 = 0 THEN 89.5 ELSE p_retailprice - 10.5 END AS fp, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS br,
      CASE p_size % 4 WHEN 0 THEN 'Big Special Sale' WHEN 1 THEN '' WHEN 2 THEN 'Lux' END AS badge, CASE WHEN p_size % 3 = 0 THEN '/g' || p_partkey || '.jpg' END AS angle, CASE WHEN p_size % 2 = 0 THEN '/s' || p_partkey || '.jpg' END AS side
      FROM part WHERE p_size % 9 > 0 AND p_partkey % 90 + 10 <> 73),
    t AS (SELECT *, string_split(replace(color, ' , ', ' '), ' ') AS words, br IN ('Brand#1', 'Brand#2', 'Brand#3') AS promo FROM s), u AS (SELECT *, {BARE} AS bare FROM t)
    SELECT sku AS id, 'in stock' AS availability, CAST(p_size % 9 AS VARCHAR) AS quantity_to_sell, 'new' AS condition,
      replace(trim(CASE WHEN contains(name, CASE WHEN p_size % 4 = 1 THEN 'Black' ELSE color END) OR contains(name, CASE WHEN p_size % 4 = 1 THEN 'Gold' ELSE color END) THEN name || ' ' || shape1 || ' ' || kw
        ELSE name || ' ' || replace(color, ' , ', '/') || ' ' || shape1 || ' ' || kw END), 'Old Label', 'Label Old')
        || ' - Price includes high quality frames, standard prescription lenses, shipping, free case and cloth. ' || fs || ' ' || color || ' Full ' || p_type || ' Mat ' || p_size % 3 || ' ' || kw
        || CASE p_size % 4 WHEN 0 THEN ' for Men.' WHEN 1 THEN ' for Women.' ELSE '.' END || ' These ' || shape || ' shaped ' || kw || ' are great for face ' || p_size % 3 || ' shaped faces. Look great in your stylish ' || kw || '. Only $' || {NUM.format('p_retailprice - 10.5')}
        || CASE WHEN p_partkey % 90 + 10 = 62 THEN '' ELSE ' - includes shipping!' END AS description,
      CASE WHEN p_size % 7 <> 0 THEN '{IMG}/x/' || p_size || '/f' || p_partkey || '.jpg' END AS image_link, 'https://shop.example/item-' || p_partkey || '.html' || CASE WHEN promo THEN '?promo=SAVE' || right(br, 1) ELSE '' END AS link,
      {TITLE} AS title, {NUM.format('pr')} || ' USD' AS price, CASE WHEN p_partkey % 3 = 0 THEN '0' || p_partkey * 7 END AS gtin, CASE WHEN p_partkey % 4 = 0 THEN 'M' || p_partkey END AS mpn, coalesce(br, 'House') AS brand,
      CASE WHEN side IS NOT NULL THEN '{IMG}' || side || CASE WHEN angle IS NOT NULL THEN ',{IMG}' || angle ELSE '' END ELSE '{IMG}' || angle END AS additional_image_link,
      CASE WHEN p_size % 3 = 1 OR lower(bare) LIKE '%kids%' THEN 'Kids' ELSE 'Adult' END AS age_group, replace(color, ' , ', '/') AS color, NULL::DATE AS expiration_date, ['Male','Female','Female','Unisex'][p_size % 4 + 1] AS gender, {TITLE} AS item_group_id,
      CASE WHEN {RX} = 'Eyeglasses' THEN 'Health & Beauty > Personal Care > Vision Care > Eyeglasses' ELSE 'Apparel & Accessories > Clothing Accessories > Sunglasses' END AS google_product_category, fs AS size, 'Mat ' || p_size % 3 AS material, NULL::VARCHAR AS pattern,
      CASE WHEN badge IS NULL OR badge = '' THEN 'Home Brand' ELSE badge END AS product_type, {NUM.format('CASE WHEN promo THEN fp * 0.75 ELSE fp END')} || ' USD' AS sale_price, NULL::DATE AS sale_price_effective_date, NULL::DOUBLE AS shipping, '0.50 lb' AS shipping_weight,
      NULL::VARCHAR AS shipping_size, CASE WHEN badge LIKE '%Special Sale%' THEN 'Special Sale' ELSE badge END AS custom_label_0, bare AS custom_label_1, CASE WHEN p_size % 6 = 0 THEN 'DSCO' ELSE 'L' || p_size % 2 END AS custom_label_2, {RX} AS custom_label_3 FROM u""")
def product_feed(spark, sf):
    return feeds.product_feed(A.stock(spark, sf), A.stock_keywords(spark, sf), A.inventory(spark, sf), A.price_fixes(spark, sf), A.gtins(spark, sf), A.mpns(spark, sf), A.promo_rules(spark, sf),
                              site="https://shop.example/", images=IMG, home_brand="House", rename={"Old Label": "Label Old"})
