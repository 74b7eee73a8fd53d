"""Subscription status queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import email as E
from ..operators import status as T
from ..sources import adapters as A
from ..sources.targets import merge, stage
from . import sqltext as S
from .email import COLS, OLD_CLICKS, ORDG, SAME_DAY, near_sql
from .registry import query

SINCE, AS_OF = date(1996, 1, 1), date(2001, 11, 5)

CREATED = """acts AS (SELECT 'u' || o_custkey || '@x' AS e, o_orderstatus AS st, o_orderdate, o_orderdate + to_minutes(o_orderkey % 1440) AS ts FROM orders WHERE o_custkey % 11 <> 2),
    moves AS (SELECT *, ts + to_hours(CASE WHEN month(ts) BETWEEN 4 AND 10 THEN -7 ELSE -8 END) AS loc FROM acts),
    known AS (SELECT 'u' || c_custkey || '@x' AS subscriber_email, TIMESTAMP '1995-02-01 08:00:00' + to_days(CAST(c_custkey % 400 AS INTEGER)) AS Datetime_Created FROM customer WHERE c_custkey % 5 = 0),
    shop AS (SELECT 'u' || o_custkey || '@x' AS subscriber_email, min(o_orderdate + to_minutes(o_orderkey % 1440)) AS Datetime_Created FROM orders
      WHERE o_custkey % 11 < 8 AND o_orderstatus = 'O' AND o_orderdate >= DATE '1996-01-01' AND 'u' || o_custkey || '@x' NOT IN (SELECT subscriber_email FROM known) GROUP BY ALL),
    fresh AS (SELECT * FROM shop UNION ALL SELECT e, min(loc) FROM moves WHERE o_orderdate >= DATE '1996-01-01' AND e NOT IN (SELECT subscriber_email FROM known)
      AND e NOT IN (SELECT subscriber_email FROM shop) GROUP BY ALL),
    created AS (SELECT * FROM known UNION ALL SELECT * FROM fresh)"""
LOG = """log AS (SELECT e AS subscriber_email, max(loc) AS Datetime_Changed, c AS Change_to FROM (SELECT *, CASE st WHEN 'O' THEN 'SUB' WHEN 'F' THEN 'UNSUB' END AS c FROM moves)
      WHERE c IS NOT NULL AND CAST(ts AS DATE) >= DATE '1996-01-01' AND e IN (SELECT subscriber_email FROM created) GROUP BY e, CAST(loc AS DATE), c)"""


def created(spark, sf):
    known = A.known_subscribers(spark, sf)
    fresh = T.subscriber_creation(A.shop_subscribers(spark, sf), A.contacts_daily(spark, sf), A.order_tz_offset(spark, sf), known, SINCE)
    return known, fresh


def logged(spark, sf):
    known, fresh = created(spark, sf)
    made = stage(known.unionByName(fresh))
    log = T.status_change_log(A.contacts_daily(spark, sf), A.order_tz_offset(spark, sf), made, SINCE)
    return made, log


@query("subscriber_creation", f"WITH {CREATED} SELECT * FROM fresh")
def subscriber_creation(spark, sf):
    return created(spark, sf)[1]


@query("status_change_log", f"""WITH {CREATED}, {LOG}, old AS (SELECT * FROM log WHERE Datetime_Changed < TIMESTAMP '2000-01-01' AND Change_to = 'SUB')
    SELECT * FROM old UNION ALL SELECT * FROM log WHERE (subscriber_email, Datetime_Changed) NOT IN (SELECT (subscriber_email, Datetime_Changed) FROM old)""")
def status_change_log(spark, sf):
    log = stage(logged(spark, sf)[1])
    old = log.where("Datetime_Changed < timestamp_ntz'2000-01-01' and Change_to = 'SUB'")
    return merge(old, log, ["subscriber_email", "Datetime_Changed"])


def monthly_sql(cond: str = "true") -> str:
    """Literal form: every customer against every month, range join to status intervals."""
    return f"""SELECT DISTINCT fo.customer_email, Order_date, m.MonthID, coalesce(first_value(sc.Change_to) OVER (PARTITION BY fo.customer_email, m.MonthID
        ORDER BY sc.tm DESC NULLS LAST, sc.Change_to DESC), 'inActive') AS Last_Status_in_month, ws.Was_Sub
      FROM (SELECT lower(customer_email) AS customer_email, CAST(min(date_trunc('month', Creation_Datetime)) AS DATE) AS Order_date FROM items
        WHERE customer_email <> '' AND {cond} GROUP BY ALL) fo
      CROSS JOIN (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-11-01', INTERVAL 1 MONTH)) AS DATE) AS MonthID) m
      LEFT JOIN sc ON sc.e = fo.customer_email AND m.MonthID BETWEEN sc.f AND sc.u
      LEFT JOIN (SELECT DISTINCT e, f, true AS Was_Sub FROM sc WHERE Change_to = 'Active') ws ON ws.e = fo.customer_email AND ws.f = m.MonthID
      WHERE m.MonthID >= Order_date"""


SC = """sc0 AS (SELECT subscriber_email AS e, Datetime_Created AS tm, 'Active' AS Change_to FROM created
      UNION ALL SELECT subscriber_email, Datetime_Changed, CASE WHEN Change_to = 'SUB' THEN 'Active' ELSE 'inActive' END FROM log),
    sc AS (SELECT *, CAST(date_trunc('month', tm) AS DATE) AS f, coalesce(lead(CAST(date_trunc('month', tm) AS DATE)) OVER (PARTITION BY e ORDER BY tm, Change_to), DATE '2001-11-01') AS u FROM sc0)"""


# before the merge: months up to 2000 without the flag, and with another status in March. The merge renews the March rows that differ and adds the later months.
@query("monthly_active_status", f"""WITH {S.ITEMS}, {CREATED}, {LOG}, {SC}, s AS ({monthly_sql()})
    SELECT customer_email, Order_date, MonthID, Last_Status_in_month, CASE WHEN MonthID >= DATE '2001-01-01' OR (month(MonthID) = 3 AND Last_Status_in_month <> 'inActive') THEN Was_Sub END AS Was_Sub FROM s""")
def monthly_active_status(spark, sf):
    made, log = logged(spark, sf)
    new = stage(T.monthly_status(A.order_items(spark, sf), made, log, AS_OF))
    old = new.where("MonthID < date'2001-01-01'").withColumn("Was_Sub", F.lit(None).cast("boolean")).withColumn(
        "Last_Status_in_month", F.when(F.month("MonthID") == 3, "inActive").otherwise(F.col("Last_Status_in_month")))
    return merge(old, new, ["customer_email", "MonthID"], update=["Last_Status_in_month", "Was_Sub"], update_when=T.monthly_changed())


def movement_sql(audience: str, cond: str) -> str:
    return f"""SELECT '{audience}' AS audience, MonthID, Active + Inactive AS Total, Active, lag(Active) OVER w AS Open_active, Active - lag(Active) OVER w AS Active_diff,
      Inactive, lag(Inactive) OVER w AS Open_inactive, Inactive - lag(Inactive) OVER w AS Inactive_diff,
      Active - lag(Active) OVER w + Inactive - lag(Inactive) OVER w AS Delta
      FROM (SELECT MonthID, count(CASE WHEN Last_Status_in_month = 'Active' THEN 1 END) AS Active, count(CASE WHEN Last_Status_in_month <> 'Active' THEN 1 END) AS Inactive
        FROM ({monthly_sql(cond)}) WHERE MonthID >= DATE '1996-06-01' GROUP BY ALL) WINDOW w AS (ORDER BY MonthID)"""


GLASSES = "EyewearType NOT IN ('Contact Lenses', 'Product Upgrade', 'Accessories')"


@query("active_base_movement", f"""WITH {S.ITEMS}, {CREATED}, {LOG}, {SC} {movement_sql('Contact Lenses', "EyewearType = 'Contact Lenses'")}
    UNION ALL {movement_sql('Eyeglasses', GLASSES)}""")
def active_base_movement(spark, sf):
    made, log = logged(spark, sf)
    both = T.monthly_status(A.order_items(spark, sf), made, log, AS_OF, ("Contact Lenses", "Eyeglasses"))
    return T.active_movement(both, date(1996, 6, 1), AS_OF)


NAMES = """fn AS (SELECT DISTINCT message_name, CASE WHEN right(message_name, 1) = '3' THEN NULL WHEN right(message_name, 1) = '2' THEN 'pps-contact ' || right(message_name, 2)
      ELSE 'mail contacts ' || right(message_name, 2) END AS Final_message_name FROM mailev),
    ca AS (SELECT DISTINCT Final_message_name, CASE right(Final_message_name, 1) WHEN '0' THEN 'Welcome' WHEN '1' THEN 'Contacts Other' ELSE 'Leads' END AS Newsletter_Category FROM fn WHERE Final_message_name IS NOT NULL),
    co AS (SELECT customer_email, Order_Number, Creation_Datetime, row_number() OVER (PARTITION BY customer_email ORDER BY Creation_Datetime, Order_Number) AS Rank FROM eord WHERE EyewearType = 'Contact Lenses')"""


@query("email_retention_revenue", f"""WITH {S.MAIL}, {S.EORD}, {ORDG}, {NAMES}, z1 AS ({near_sql(OLD_CLICKS, SAME_DAY, 'ActionDateTime')}), z2 AS ({near_sql('(SELECT DISTINCT * FROM ecl)')}),
    a AS (SELECT ActionDateTime, EmailAddress, Order_id, MessageName FROM z1 UNION ALL SELECT ActionDateTime, EmailAddress, Order_id, MessageName FROM z2)
    SELECT CAST(a.ActionDateTime AS DATE) AS Date_Time, CAST(a.ActionDateTime AS DATE) AS Date, md5(lower(a.EmailAddress)) AS EmailAddress, fn.Final_message_name, Newsletter_Category,
      CASE WHEN Newsletter_Category = 'Welcome' AND fn.Final_message_name LIKE '%contact%' THEN 'Auto' WHEN fn.Final_message_name LIKE '%pps-contact%' THEN 'Auto'
        WHEN Newsletter_Category LIKE '%Contact%' THEN 'Newsletter Contacts' ELSE 'Eyeglasses Emails' END AS Newsletter_Segment,
      round(CASE WHEN FrameType = 'Contact Lenses' THEN ItemRevenue ELSE 0 END, 2) AS Contacts_Revenue, round(CASE WHEN FrameType <> 'Contact Lenses' THEN ItemRevenue ELSE 0 END, 2) AS Glasses_Revenue,
      CASE WHEN co.Rank > 1 THEN 'Return' ELSE 'New' END AS New_Ret, New_Returning AS New_Ret_Total, c1.Creation_Datetime AS Cohort_Date
    FROM a JOIN eord ON CAST(Order_Number AS VARCHAR) = a.Order_id AND lower(eord.customer_email) = lower(a.EmailAddress)
    LEFT JOIN co ON co.customer_email = eord.customer_email AND co.Order_Number = eord.Order_Number
    LEFT JOIN co c1 ON c1.customer_email = eord.customer_email AND c1.Rank = 1
    JOIN fn ON lower(a.MessageName) = lower(fn.message_name) AND fn.Final_message_name IS NOT NULL LEFT JOIN ca ON ca.Final_message_name = fn.Final_message_name""")
def email_retention_revenue(spark, sf):
    clicks = A.event_clicks(spark, sf)
    orders, media = A.event_orders(spark, sf), A.order_last_media(spark, sf)
    old_clicks = clicks.drop("Device").withColumnsRenamed({"email": "EmailAddress", "Sent_Datetime_PST": "DeliveryDate",
                                                           "click_Datetime_PST": "ActionDateTime", "message_name": "MessageName"})
    credited = [E.click_to_order_same_day(old_clicks, orders, media), E.click_to_order(clicks, orders, media)]
    names = clicks.select("message_name").distinct().withColumn(
        "Final_message_name", F.expr("case when right(message_name, 1) = '3' then null when right(message_name, 1) = '2' "
                                     "then 'pps-contact ' || right(message_name, 2) else 'mail contacts ' || right(message_name, 2) end"))
    cats = names.where("Final_message_name is not null").select("Final_message_name", F.expr(
        "case right(Final_message_name, 1) when '0' then 'Welcome' when '1' then 'Contacts Other' else 'Leads' end").alias("Newsletter_Category")).distinct()
    out = T.retention_revenue(credited, orders, A.contact_orders(spark, sf), names, cats, date(2023, 12, 1), date(2024, 2, 1))
    return out.withColumns({c: F.round(c, 2) for c in ("Contacts_Revenue", "Glasses_Revenue")})
