"""E-mail queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import email as E
from ..sources import adapters as A
from ..sources.targets import current, merge, overwrite, publish, publish_newer, reload_window, scratch, stage
from . import sqltext as S
from .registry import query

PREMIUM = ["Brand#1", "Brand#2", "Brand#3"]
BUCKETS = {"orders": ([(1, "1 order"), (8, "2-8 orders")], "9+ orders"),
           "days": ([(8200, "<=8200"), (8600, "<=8600")], ">8600"), "premium": PREMIUM}
NEAR = {"orders": ([(1, "1 order"), (3, "2-3 orders")], "4+ orders"), "days": ([(30, "<=30"), (365, "<=365")], ">365"), "premium": PREMIUM}
SEG = "noOfOrders, daySinceLastOrder, productType, lensType, brandType"

ORDH = """ordh AS (SELECT lower(customer_email) AS oe, Creation_Datetime AS t, CAST(Order_Number AS VARCHAR) AS o,
    bool_or(EyewearType = 'Contact Lenses') AS c, bool_or(EyewearType <> 'Contact Lenses') AS g, max(LensType) AS lens,
    bool_or(brand IN ('Brand#1', 'Brand#2', 'Brand#3')) AS p FROM items WHERE customer_email <> '' GROUP BY ALL)"""


def seg_sql(keys: str, buckets: dict) -> str:
    """CTE ``seg`` keyed by lower e-mail ``se`` and day ``sd`` for a query giving columns e and d."""

    def ladder(x: str, rule) -> str:
        return "CASE " + " ".join(f"WHEN {x} <= {b} THEN '{t}'" for b, t in rule[0]) + f" ELSE '{rule[1]}' END"

    return f"""sk AS (SELECT DISTINCT lower(e) AS se, d AS sd FROM ({keys}) WHERE e IS NOT NULL AND d IS NOT NULL),
    seg AS (SELECT se, sd, {ladder('n', buckets['orders'])} AS noOfOrders,
      {ladder("(sd - CAST(t AS DATE))", buckets['days'])} AS daySinceLastOrder,
      CASE WHEN c AND g THEN 'Both' WHEN c THEN 'Contacts' ELSE 'Glasses' END AS productType, lens AS lensType,
      CASE WHEN p THEN 'Premium' ELSE 'Home' END AS brandType
      FROM (SELECT *, count(*) OVER (PARTITION BY se, sd) AS n, row_number() OVER (PARTITION BY se, sd ORDER BY t DESC, o DESC) AS r
            FROM sk JOIN ordh ON se = oe AND t < sd) WHERE r = 1)"""


def unknown(prefix: str = "") -> str:
    return ", ".join(f"coalesce({prefix}{c.strip()}, 'Unknown') AS {c.strip()}" for c in SEG.split(","))


SENT0 = """sent0 AS (SELECT DISTINCT ts AS Sent_datetime_UTC, ts + to_hours(pst) AS Sent_Datetime_PST, email, action, message_name,
    mdtID, msID, experiment, variant, mTags FROM asent LEFT JOIN tz ON CAST(ts AS DATE) = Date WHERE email IS NOT NULL)"""
SENT = f"""{S.MAIL}, {S.ITEMS}, {ORDH}, {SENT0}, {seg_sql('SELECT email AS e, CAST(Sent_Datetime_PST AS DATE) AS d FROM sent0', BUCKETS)},
    sent AS (SELECT sent0.* REPLACE (coalesce(mTags, '["None"]') AS mTags), {unknown('seg.')} FROM sent0
      LEFT JOIN seg ON lower(email) = se AND CAST(Sent_Datetime_PST AS DATE) = sd)"""


def fact_sql(action: str) -> str:
    link = "link AS linkUrl, linkname" if action == "click" else "NULL::VARCHAR AS linkUrl, NULL::VARCHAR AS linkname"
    dev = "NULL::VARCHAR AS Device, NULL::VARCHAR AS Device_OS" if action == "bounce" else "Device, Device_OS"
    return f"""SELECT DISTINCT '{action}' AS kind, a.ts AS event_datetime_UTC, a.ts + to_hours(pst) AS event_Datetime_PST,
      s.Sent_datetime_UTC AS Sent_Datetime_UTC, s.Sent_Datetime_PST, a.email, a.message_name, a.msID, {link}, {dev}, {SEG}, mTags
    FROM act a JOIN sent s USING (email, message_name, msID) LEFT JOIN tz ON CAST(a.ts AS DATE) = tz.Date
    WHERE a.action = '{action}' AND CAST(a.ts + to_hours(pst) AS DATE) < DATE '2024-01-31'"""


FACTS = SENT + ", " + ", ".join(f"f_{k} AS ({fact_sql(k)})" for k in ("open", "click", "optout", "bounce"))


def segmenter(spark, sf, buckets=BUCKETS):
    items = A.order_items(spark, sf)
    return lambda df, mail, day: E.segment_asof(df, items, buckets, mail, day)


def sent(spark, sf):
    return E.sent_messages(A.message_activity_sent(spark, sf), A.tz_offset(spark, sf), segmenter=segmenter(spark, sf))


def facts(spark, sf):
    mail = stage(sent(spark, sf))  # read by five jobs below, as the report table it is
    acts, off = A.message_activity(spark, sf), A.tz_offset(spark, sf)
    out = {k: E.message_fact(acts, mail, off, k, as_of=date(2024, 1, 31)) for k in ("open", "click", "optout", "bounce")}
    out["click"] = stage(out["click"])  # read here and by the funnels
    clicks = out["click"].select("email", "Sent_Datetime_PST", F.col("event_Datetime_PST").alias("click_Datetime_PST"), "message_name",
                                 "mTags", *E.SEGMENTS, "linkUrl", "linkname", "Device", "Device_OS")
    out["order"] = E.click_to_order(clicks, A.event_orders(spark, sf), A.order_last_media(spark, sf))
    out["order"] = stage(out["order"])
    return {"sent": mail, **out}


@query("hourly_activity", f"""WITH {S.MAIL}, h AS (SELECT date_trunc('hour', ts) AS DateTime, action AS Type FROM act
      UNION ALL SELECT date_trunc('hour', ts), 'Message_Sent' FROM asent)
    SELECT DateTime, Type, DateTime + to_hours(pst) AS Datetime_PST, DateTime + to_hours(pst + 3) AS Datetime_EST,
      DateTime + to_hours(2) AS Datetime_ILS, count(*) AS Amount FROM h LEFT JOIN tz ON CAST(DateTime AS DATE) = Date GROUP BY ALL""")
def hourly_activity(spark, sf):
    return E.hourly_activity(A.message_activity(spark, sf), A.message_activity_sent(spark, sf), A.tz_offset(spark, sf))


CHANGES = """chg AS (SELECT lower(channels_email_address) AS ce, st AS subscribeStatus, t + to_hours(CASE WHEN month(t) BETWEEN 4 AND 10 THEN -7 ELSE -8 END) AS since
    FROM (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'U' ELSE 'u' END || o_custkey || '@x' AS channels_email_address,
        CASE o_orderstatus WHEN 'O' THEN 'subscribed' WHEN 'F' THEN 'unsubscribed' ELSE 'none' END AS st,
        o_orderdate + to_minutes(o_orderkey % 1440) AS t FROM orders WHERE o_custkey % 11 <> 2
      UNION ALL SELECT CASE WHEN c_custkey % 2 = 0 THEN 'U' ELSE 'u' END || c_custkey || '@x',
        CASE WHEN c_custkey % 3 = 0 THEN 'unsubscribed' ELSE 'subscribed' END,
        CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '1995-01-01 11:00:00' ELSE TIMESTAMP '1995-01-01 10:00:00' END + to_days(CAST(c_custkey % 900 AS INTEGER))
        FROM customer WHERE c_custkey % 7 <> 3)
    WHERE CAST(t AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders))"""


@query("email_status_asof", f"""WITH {CHANGES}, k AS (SELECT DISTINCT 'U' || o_custkey || '@X' AS email, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT email, day, subscribeStatus FROM k LEFT JOIN (SELECT k.email, k.day, subscribeStatus,
        row_number() OVER (PARTITION BY k.email, k.day ORDER BY since DESC, subscribeStatus DESC) AS r
      FROM k JOIN chg ON lower(k.email) = ce AND since < k.day) USING (email, day) WHERE r = 1 OR r IS NULL""")
def email_status_asof(spark, sf):
    keys = A.table(spark, sf, "orders").select(F.expr("'U' || o_custkey || '@X'").alias("email"), F.to_date("o_orderdate").alias("day")).distinct()
    changes = A.contacts(spark, sf).unionByName(A.contacts_daily(spark, sf).drop("ingest_ts"))
    return E.status_asof(keys, changes, A.order_tz_offset(spark, sf))


@query("customer_segment_asof", f"""WITH {S.ITEMS}, {ORDH},
    k AS (SELECT DISTINCT 'u' || o_custkey || '@x' AS email, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS day FROM orders),
    {seg_sql('SELECT email AS e, day AS d FROM k', NEAR)}
    SELECT email, day, {unknown('seg.')} FROM k LEFT JOIN seg ON email = se AND day = sd""")
def customer_segment_asof(spark, sf):
    keys = A.table(spark, sf, "orders").select(F.expr("'u' || o_custkey || '@x'").alias("email"),
                                               F.expr("date_add(o_orderdate, cast(o_orderkey % 60 as int))").alias("day")).distinct()
    return E.segment_asof(keys, A.order_items(spark, sf), NEAR)


@query("recommendation_list", """SELECT md5(p_name || p_partkey) AS id, 'u' || p_partkey || '@x' AS email,
    '["' || replace(CAST(p_size AS VARCHAR) || ',' || p_brand, ',', '","') || '"]' AS recs FROM part WHERE p_size % 4 <> 0""")
def recommendation_list(spark, sf):
    return E.recommendation_list(A.table(spark, sf, "part").select(
        F.expr("md5(p_name || p_partkey)").alias("id"), F.expr("'  u' || p_partkey || '@x '").alias("subscriber_email"),
        F.expr("case when p_size % 4 = 0 then '[]' else '[' || p_size || ',' || p_brand || ']' end").alias("RecProducts")))


@query("sent_messages", f"WITH {SENT} SELECT * FROM sent WHERE CAST(Sent_Datetime_PST AS DATE) >= DATE '2024-01-02'")
def sent_messages(spark, sf):
    return E.sent_messages(A.message_activity_sent(spark, sf), A.tz_offset(spark, sf), date(2024, 1, 2), segmenter(spark, sf))


@query("message_fact", f"WITH {FACTS} " + " UNION ALL ".join(f"SELECT * FROM f_{k}" for k in ("open", "click", "optout", "bounce")))
def message_fact(spark, sf):
    f = facts(spark, sf)
    return f["open"].unionByName(f["click"]).unionByName(f["optout"]).unionByName(f["bounce"])


@query("message_fact_reload", f"""WITH {FACTS} SELECT email, message_name, event_Datetime_PST, 'old' AS src FROM f_open
    WHERE CAST(event_Datetime_PST AS DATE) < DATE '2024-01-21'
    UNION ALL SELECT email, message_name, event_Datetime_PST, 'new' FROM f_open WHERE CAST(event_Datetime_PST AS DATE) >= DATE '2024-01-21'""")
def message_fact_reload(spark, sf):
    rows = facts(spark, sf)["open"].select("email", "message_name", "event_Datetime_PST")
    fresh = rows.where(F.to_date("event_Datetime_PST") >= F.lit(date(2024, 1, 21)))
    return reload_window(rows.withColumn("src", F.lit("old")), fresh.withColumn("src", F.lit("new")), "event_Datetime_PST", date(2024, 1, 21))


ORDG = """og AS (SELECT customer_email, CAST(Order_Number AS VARCHAR) AS Order_id, CAST(Creation_Datetime AS DATE) AS Date,
    Creation_Datetime AS Date_Time, coalesce(Order_Coupon, 'No Coupon') AS Coupon, sum(ItemRevenue) AS Revenue,
    sum(CASE WHEN EyewearType = 'Contact Lenses' THEN ItemRevenue ELSE 0 END) AS Revenue_Contacts,
    CASE WHEN lower(any_value(media)) LIKE '%newsletter%' THEN 'Last Click' ELSE 'Assisted' END AS Order_Att FROM eord GROUP BY ALL)"""
COLS = """EmailAddress, DeliveryDate, ActionDateTime, MessageName, mTags, noOfOrders, Order_id, Date, Date_Time,
    round(Revenue, 2) AS Revenue, Rank, Coupon, linkUrl, Order_Att, linkname, round(Revenue_Contacts, 2) AS Revenue_Contacts"""


def near_sql(clicks: str, extra: str = "", order: str = "DeliveryDate, ActionDateTime") -> str:
    return f"""SELECT *, CAST(1 AS INTEGER) AS Rank FROM (SELECT *, rank() OVER (PARTITION BY EmailAddress, Order_id ORDER BY {order}) AS rk
      FROM {clicks} c JOIN og ON lower(EmailAddress) = lower(customer_email) AND Date_Time >= ActionDateTime
        AND date_diff('minute', ActionDateTime, Date_Time) BETWEEN 0 AND 480 {extra}) WHERE rk = 1"""


def rounded(df):
    return df.withColumn("Revenue", F.round("Revenue", 2)).withColumn("Revenue_Contacts", F.round("Revenue_Contacts", 2))


@query("click_to_order", f"WITH {S.MAIL}, {S.EORD}, {ORDG}, z AS ({near_sql('(SELECT DISTINCT * FROM ecl)')}) SELECT {COLS} FROM z")
def click_to_order(spark, sf):
    return rounded(E.click_to_order(A.event_clicks(spark, sf), A.event_orders(spark, sf), A.order_last_media(spark, sf)))


OLD_CLICKS = """(SELECT DISTINCT EmailAddress, DeliveryDate, ActionDateTime - INTERVAL 3 HOUR AS ActionDateTime, MessageName, mTags, noOfOrders, linkUrl, linkname
    FROM (SELECT *, rank() OVER (PARTITION BY EmailAddress, MessageName, DeliveryDate,
      CASE WHEN MessageName LIKE '%PPS%' THEN ActionDateTime ELSE ActionDateTime - INTERVAL 3 HOUR END ORDER BY linkUrl NULLS FIRST) AS lr FROM ecl) WHERE lr = 1)"""
SAME_DAY = "AND CAST(Date_Time AS DATE) = CAST(ActionDateTime AS DATE)"


@query("click_to_order_same_day", f"WITH {S.MAIL}, {S.EORD}, {ORDG}, z AS ({near_sql(OLD_CLICKS, SAME_DAY, 'ActionDateTime')}) SELECT {COLS} FROM z")
def click_to_order_same_day(spark, sf):
    clicks = A.event_clicks(spark, sf).drop("Device").withColumnsRenamed(
        {"email": "EmailAddress", "Sent_Datetime_PST": "DeliveryDate", "click_Datetime_PST": "ActionDateTime", "message_name": "MessageName"})
    return rounded(E.click_to_order_same_day(clicks, A.event_orders(spark, sf), A.order_last_media(spark, sf)))


FUN = f"""{FACTS}, {S.EORD}, {ORDG}, fc AS (SELECT DISTINCT email AS EmailAddress, Sent_Datetime_PST AS DeliveryDate, event_Datetime_PST AS ActionDateTime,
      message_name AS MessageName, mTags, {SEG}, linkUrl, linkname, Device, Device_OS FROM f_click),
    f_order AS ({near_sql('fc')})"""
KEYS = "DeliveryDate, MessageName, mTags, " + SEG
D_AGG = """count(*) AS {0}, count(DISTINCT email) AS {1}, CAST(sum(CASE WHEN CAST(Sent_Datetime_PST AS DATE) = CAST(event_Datetime_PST AS DATE) THEN 1 ELSE 0 END) AS BIGINT) AS {2},
    count(DISTINCT CASE WHEN CAST(Sent_Datetime_PST AS DATE) = CAST(event_Datetime_PST AS DATE) THEN email END) AS {3}"""


def per_delivery(table: str, agg: str) -> str:
    return f"""SELECT CAST(a.Sent_Datetime_PST AS DATE) AS DeliveryDate, message_name AS MessageName, mTags, {SEG}, {agg} FROM {table} a
      JOIN ml ON ml.MessageName = a.message_name AND ml.DeliveryDate = CAST(a.Sent_Datetime_PST AS DATE) GROUP BY ALL"""


FUNNEL = f"""{FUN}, ml AS (SELECT DISTINCT message_name AS MessageName, CAST(Sent_Datetime_PST AS DATE) AS DeliveryDate FROM (
      SELECT message_name, Sent_Datetime_PST FROM sent WHERE CAST(Sent_Datetime_PST AS DATE) >= DATE '2024-01-11'
      {' '.join(f"UNION ALL SELECT message_name, Sent_Datetime_PST FROM f_{k} WHERE CAST(event_Datetime_PST AS DATE) >= DATE '2024-01-11'" for k in ('open', 'click', 'optout', 'bounce'))})),
    de AS ({per_delivery('sent', 'count(*) AS Sent')}), op AS ({per_delivery('f_open', D_AGG.format('open', 'Unique_open', 'Open_D0', 'Unique_open_D0'))}),
    cl AS ({per_delivery('f_click', D_AGG.format('clicks', 'Unique_clicks', 'clicks_D0', 'Unique_click_D0'))}),
    un AS ({per_delivery('f_optout', 'count(*) AS unsub')}),
    bo AS ({per_delivery('f_bounce', 'count(*) AS bounce, CAST(0 AS INTEGER) AS hard_bounce, CAST(0 AS INTEGER) AS soft_bounce')}),
    co AS (SELECT CAST(a.DeliveryDate AS DATE) AS DeliveryDate, a.MessageName, mTags, {SEG}, count(*) AS orders, round(sum(Revenue), 2) AS revenue,
        CAST(sum(CASE WHEN CAST(a.DeliveryDate AS DATE) = CAST(ActionDateTime AS DATE) THEN 1 ELSE 0 END) AS BIGINT) AS Orders_D0,
        round(sum(CASE WHEN CAST(a.DeliveryDate AS DATE) = CAST(ActionDateTime AS DATE) THEN Revenue ELSE 0 END), 2) AS revenue_D0,
        round(sum(Revenue_Contacts), 2) AS Contacts_Revenue,
        round(sum(CASE WHEN CAST(a.DeliveryDate AS DATE) = CAST(ActionDateTime AS DATE) THEN Revenue_Contacts ELSE 0 END), 2) AS Contacts_Revenue_D0
      FROM f_order a JOIN ml ON ml.MessageName = a.MessageName AND ml.DeliveryDate = CAST(a.DeliveryDate AS DATE) GROUP BY ALL)
    SELECT * FROM de {' '.join(f'LEFT JOIN {x} USING ({KEYS})' for x in ('op', 'cl', 'co', 'un', 'bo'))}"""


def rounded_funnel(df):
    return df.withColumns({c: F.round(c, 2) for c in df.columns if "evenue" in c})


@query("message_funnel_delivery", f"WITH {FUNNEL}")
def message_funnel_delivery(spark, sf):
    return rounded_funnel(E.message_funnel(facts(spark, sf), date(2024, 1, 11)))


@query("message_funnel_merge", f"""WITH {FUNNEL.rsplit('SELECT * FROM de', 1)[0]} f AS (SELECT * FROM de {' '.join(f'LEFT JOIN {x} USING ({KEYS})' for x in ('op', 'cl', 'co', 'un', 'bo'))})
    SELECT {KEYS}, Sent, clicks, orders FROM f UNION ALL SELECT DeliveryDate - 365, MessageName, mTags, {SEG}, -1, clicks, orders FROM f WHERE orders IS NOT NULL""".replace("GROUP BY ALL)\n     f AS", "GROUP BY ALL),\n    f AS"))
def message_funnel_merge(spark, sf):
    """Null-safe merge that always renews matched rows and keeps rows the source does not hold."""
    rows = stage(E.message_funnel(facts(spark, sf), date(2024, 1, 11)).select(*E.FUNNEL_KEYS, "Sent", "clicks", "orders"))
    stale = rows.where("Sent > 1").withColumn("Sent", F.lit(0).cast("long")).withColumn("clicks", F.lit(None).cast("long"))
    older = rows.where("orders is not null").withColumn("DeliveryDate", F.date_sub("DeliveryDate", 365)).withColumn("Sent", F.lit(-1).cast("long"))
    return merge(stale.unionByName(older), rows, ["DeliveryDate", "MessageName"], nullsafe=["mTags", *E.SEGMENTS], update=["Sent", "clicks", "orders"])


def per_action(table: str, agg: str, at: str = "event_Datetime_PST", name: str = "message_name") -> str:
    return f"SELECT CAST({at} AS DATE) AS ActionDate, {name} AS MessageName, mTags, {SEG}, {agg} FROM {table} GROUP BY ALL"


AKEYS = "ActionDate, MessageName, mTags, " + SEG


@query("message_funnel_action", f"""WITH {FUN}, sp AS (SELECT DISTINCT {AKEYS} FROM (
      {' UNION ALL '.join(per_action('f_' + k, 'count(*) AS n') for k in ('open', 'click', 'optout', 'bounce'))}
      UNION ALL {per_action('f_order', 'count(*) AS n', 'ActionDateTime', 'MessageName')}) WHERE ActionDate >= DATE '2024-01-11'),
    op AS ({per_action('f_open', 'count(*) AS open, count(DISTINCT email) AS Unique_open')}),
    cl AS ({per_action('f_click', 'count(*) AS clicks, count(DISTINCT email) AS Unique_clicks')}),
    co AS ({per_action('f_order', 'count(*) AS orders, round(sum(Revenue), 2) AS revenue, round(sum(Revenue_Contacts), 2) AS Contacts_Revenue', 'ActionDateTime', 'MessageName')}),
    un AS ({per_action('f_optout', 'count(*) AS unsub')})
    SELECT * FROM sp {' '.join(f'LEFT JOIN {x} USING ({AKEYS})' for x in ('op', 'cl', 'co', 'un'))}""")
def message_funnel_action(spark, sf):
    return rounded_funnel(E.message_funnel_action(facts(spark, sf), date(2024, 1, 11)))


@query("report_snapshot", f"WITH {S.MAIL} SELECT CAST(ts AS DATE) AS ActionDate, message_name, count(*) AS n FROM act WHERE CAST(ts AS DATE) < DATE '2024-01-30' GROUP BY ALL")
def report_snapshot(spark, sf):
    view = A.message_activity(spark, sf).groupBy(F.to_date(E.as_datetime("time")).alias("ActionDate"), "message_name").agg(F.count(F.lit(1)).alias("n"))
    return overwrite(view, E.report_snapshot(view, "ActionDate", date(2024, 1, 30)))


# ---- tests on message templates: final names drop the campaign number, two of four versions are under test

AB = f"""z AS ({near_sql('(SELECT DISTINCT * FROM ecl)')}),
    ab AS (SELECT DISTINCT fn.Final_message_name, md5(lower(c.EmailAddress)) AS EmailAddress, c.DeliveryDate AS Sent_Datetime_PST,
      c.ActionDateTime AS click_Datetime_PST, c.MessageName AS message_name, c.linkUrl, c.linkname, c.Device, c.mTags, c.noOfOrders,
      z.Order_id, fn.Final_message_name AS Bulk_Message_name, 'Offer ' || right(fn.Final_message_name, 1) AS Offer, t.TestName,
      'Ver' || right(fn.Final_message_name, 1) AS AB_Test_Version
    FROM ecl c JOIN (SELECT DISTINCT message_name, 'final_' || right(message_name, 2) AS Final_message_name FROM mailev) fn ON lower(c.MessageName) = lower(fn.message_name)
    LEFT JOIN (SELECT DISTINCT DeliveryDate, ActionDateTime, EmailAddress, MessageName, linkUrl, Order_id FROM z) z
      ON c.DeliveryDate = z.DeliveryDate AND c.ActionDateTime = z.ActionDateTime AND c.EmailAddress = z.EmailAddress
      AND c.MessageName = z.MessageName AND c.linkUrl IS NOT DISTINCT FROM z.linkUrl
    JOIN (VALUES ('Template', 'ver1'), ('Template', 'ver2'), ('Colour', 'ver2')) t(TestName, Ver) ON t.Ver = lower('Ver' || right(fn.Final_message_name, 1))
    WHERE c.DeliveryDate >= TIMESTAMP '2024-01-03' AND c.MessageName NOT LIKE '6.1.24%')"""


def ab_clicks(spark, sf):
    clicks = A.event_clicks(spark, sf)
    names = clicks.select("message_name").distinct()
    final = names.select(F.upper("message_name").alias("message_name"), F.expr("'final_' || right(message_name, 2)").alias("Final_message_name"))
    attributes = final.select(F.col("Final_message_name").alias("Bulk_Message_name"), F.expr("'Offer ' || right(Final_message_name, 1)").alias("Offer"),
                              F.expr("' Ver' || right(Final_message_name, 1)").alias("AB_Test_Version")).distinct()
    groups = spark.createDataFrame([("Template", "VER1 "), ("Template", "ver2"), ("Colour", "Ver2")], "TestName string, Ver string")
    excluded = names.where("message_name like '6.1.24%'").select(F.upper("message_name").alias("Email_exclude"))
    credited = E.click_to_order(clicks, A.event_orders(spark, sf), A.order_last_media(spark, sf))
    return E.ab_test_clicks(clicks, credited, final, attributes, groups, excluded, date(2024, 1, 3))


@query("ab_test_clicks", f"WITH {S.MAIL}, {S.EORD}, {ORDG}, {AB} SELECT * FROM ab")
def ab_test_clicks(spark, sf):
    return ab_clicks(spark, sf)


@query("ab_test_sent", f"""WITH {S.MAIL}, {S.EORD}, {ORDG}, {AB}, {SENT0} SELECT CAST(Sent_Datetime_PST AS DATE) AS Sent_Date, message_name, count(*) AS Sent
    FROM sent0 WHERE lower(message_name) IN (SELECT lower(message_name) FROM ab) GROUP BY ALL""")
def ab_test_sent(spark, sf):
    return E.ab_test_sent(E.sent_messages(A.message_activity_sent(spark, sf), A.tz_offset(spark, sf)), ab_clicks(spark, sf))


@query("ab_test_orders", f"""WITH {S.MAIL}, {S.EORD}, {ORDG}, {AB} SELECT Order_Number, md5(lower(customer_email)) AS EmailAddress, EyewearType, FrameType,
    LensType, Order_Coupon, New_Returning, ItemRevenue, Item_Qty_Ordered, Creation_Datetime FROM eord WHERE CAST(Order_Number AS VARCHAR) IN (SELECT Order_id FROM ab WHERE Order_id IS NOT NULL)""")
def ab_test_orders(spark, sf):
    return E.ab_test_orders(A.event_orders(spark, sf), ab_clicks(spark, sf))


# ---- older platform

LEGACY = f"""{S.MAIL}, inb AS (SELECT CAST(ts AS DATE) AS date, date_trunc('second', ts) AS tm,
      CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(ts - to_days(k % 5) AS DATE) END AS start_date,
      CASE event_type WHEN 'error' THEN 'open' WHEN 'click' THEN 'click' ELSE CASE WHEN k < 50 THEN 'unsubscribe' ELSE 'bounce' END END AS kind,
      CASE WHEN k % 4 = 3 THEN 'PPS-contacts c' || k % 3 WHEN k % 11 = 0 THEN '1.13.24_bad' ELSE message_name END AS MessageName,
      mail AS EmailAddress, '/l/' || k % 5 AS linkUrl, 'n' || k % 5 AS linkname, 'Reason r' || k % 4 AS reason, k FROM mailev WHERE event_type IN ('error', 'click', 'signup')),
    dd AS (SELECT DISTINCT MessageName, TRY_CAST(CASE length(regexp_extract(split_part(MessageName, '.', 3), '^\\d+')) WHEN 4 THEN '' WHEN 2 THEN '20' END || regexp_extract(split_part(MessageName, '.', 3), '^\\d+') || '-' || split_part(MessageName, '.', 2) || '-' || split_part(MessageName, '.', 1) AS DATE) AS DDate
      FROM inb WHERE regexp_matches(MessageName, '^[0-9]'))"""


@query("delivery_date_from_name", f"WITH {LEGACY} SELECT * FROM dd UNION ALL (SELECT 'gone ' || MessageName, DDate FROM dd ORDER BY MessageName LIMIT 1)")
def delivery_date_from_name(spark, sf):
    names = A.legacy_inbound(spark, sf).select(F.col("messageName").alias("MessageName"))
    dates = stage(E.delivery_date(names))
    # before: some names, and one that doesn't come again
    old = dates.where("length(MessageName) % 2 = 0")
    gone = dates.orderBy("MessageName").limit(1).withColumn("MessageName", F.concat(F.lit("gone "), "MessageName"))
    return merge(old.unionByName(gone), dates, ["MessageName"])


OUT = """outb AS (SELECT CAST(ts AS DATE) AS day0, CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(ts + to_days(k % 3 - 1) AS DATE) END AS cd,
    ['bulk','Test','triggered'][k % 3 + 1] AS deliveryType, message_name AS messageName, mail AS e FROM mailev WHERE event_type = 'view')"""


@query("sent_by_segment", f"""WITH {S.MAIL}, {S.ITEMS}, {ORDH}, {OUT}, {seg_sql('SELECT e, cd AS d FROM outb', BUCKETS)}
    SELECT CASE WHEN day0 > cd THEN day0 ELSE cd END AS date, messageName, deliveryType, {unknown('seg.')}, count(*) AS Sent
    FROM outb LEFT JOIN seg ON lower(e) = se AND cd = sd WHERE day0 > DATE '2024-01-10' AND lower(deliveryType) <> 'test' GROUP BY ALL""")
def sent_by_segment(spark, sf):
    rows = A.legacy_outbound(spark, sf)
    target = rows.where("date <= '2024-01-10'").select(F.col("date").cast("date").alias("date"))
    return E.sent_by_segment(rows, target, segmenter(spark, sf))


def legacy_sql(kind: str, at: str, distinct: str) -> str:
    link = "linkUrl, linkname" if kind == "click" else "NULL::VARCHAR AS linkUrl, NULL::VARCHAR AS linkname"
    reason = "CASE WHEN k % 4 <> 3 THEN reason END" if kind == "bounce" else "NULL::VARCHAR"
    return f"""SELECT {distinct} '{kind}' AS kind, coalesce(DDate, start_date) AS DeliveryDate, {at} AS acted, EmailAddress, MessageName, {link},
      {reason} AS BounceReason FROM inb LEFT JOIN dd USING (MessageName) WHERE kind = '{kind}' AND {at} > (SELECT max({at}) FROM inb WHERE kind = '{kind}' AND date <= DATE '2024-01-20')"""


@query("legacy_message_fact", f"""WITH {LEGACY}, {S.ITEMS}, {ORDH}, lf AS ({legacy_sql('open', 'CAST(date AS TIMESTAMP)', 'DISTINCT')} UNION ALL {legacy_sql('click', 'tm', 'DISTINCT')}
      UNION ALL {legacy_sql('unsubscribe', 'CAST(date AS TIMESTAMP)', '')} UNION ALL {legacy_sql('bounce', 'CAST(date AS TIMESTAMP)', '')}),
    {seg_sql('SELECT EmailAddress AS e, DeliveryDate AS d FROM lf', BUCKETS)}
    SELECT lf.*, {unknown('seg.')} FROM lf LEFT JOIN seg ON lower(EmailAddress) = se AND DeliveryDate = sd""")
def legacy_message_fact(spark, sf):
    rows = A.legacy_inbound(spark, sf)
    dates = E.delivery_date(rows.select(F.col("messageName").alias("MessageName")))
    reasons = spark.createDataFrame([(f"r{i}", f"Reason r{i}") for i in range(3)], "bounceReason string, BounceReason_Name string")
    seg, out = segmenter(spark, sf), None
    for kind in ("open", "click", "unsubscribe", "bounce"):
        at = "ActionDateTime" if kind == "click" else "ActionDate"
        target = E.legacy_fact(rows.where("date <= '2024-01-20'"), dates, kind, reasons=reasons)
        one = E.legacy_fact(rows, dates, kind, target, reasons).withColumnRenamed(at, "acted")
        one = one.drop(*E.SEGMENTS).withColumn("acted", F.col("acted").cast("timestamp_ntz")).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return E.segmented(out, seg, "EmailAddress", F.col("DeliveryDate"))


@query("append_newer_activity", f"""WITH {S.MAIL} SELECT email, action, ts FROM act WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'
    UNION ALL SELECT email, action, ts FROM act WHERE ts > (SELECT max(ts) FROM act WHERE ts <= TIMESTAMP '2024-01-20 12:00:00')""")
def append_newer_activity(spark, sf):
    rows = A.message_activity(spark, sf).select("email", "action", E.as_datetime("time").alias("ts"))
    path = scratch(spark)
    publish(spark, rows.where("ts <= timestamp_ntz'2024-01-20 12:00:00'"), path, "old", marks=["ts"])
    publish_newer(spark, path, rows, "ts", "new")
    return current(spark, path)
