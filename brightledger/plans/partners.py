"""Partner queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import partners as P
from ..sources import adapters as A
from ..sources.targets import append_new, nth_row, overwrite, stage, stage_partitioned
from . import sqltext as S
from .registry import query

AS_OF, SINCE = date(2001, 11, 5), date(1996, 1, 1)
MEDIA, CODES, TESTS = ["%creatorsgm%", "%creators-a%"], ["%batcha%"], ["test100%", "trial%"]

PLAN = """plan AS (SELECT l_suppkey AS s, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, round(sum(l_quantity), 2) AS tb FROM lineitem GROUP BY ALL)"""
ORD = "Budget_Date NULLS FIRST, Planned_Date NULLS FIRST, Fee_Type, AcctMgr NULLS FIRST, Budget"
CLOSE = f"""CASE WHEN Fee_Type = 'Commission Only' THEN last_day(Budget_Date) ELSE coalesce(CAST(lead(Budget_Date) OVER (PARTITION BY Channel_Name ORDER BY {ORD}) - 1 AS DATE), DATE '2001-11-04') END AS ToDate"""
PLANNED = "CASE WHEN s % 17 = 3 AND month(m) = 2 THEN NULL ELSE m END"
LIVE = "CAST(m + CAST(s % 20 AS INTEGER) AS DATE)"
PERIODS = f"""{PLAN}, b0 AS (SELECT CASE WHEN s % 50 = 49 THEN 'LTB' ELSE 'Ch ' || s END AS Channel_Name, CASE WHEN s % 50 = 49 THEN 'LTB' ELSE 'Mgr' || s % 3 END AS AcctMgr,
      ['Flat', 'Flat + Commission', 'Commission Only', 'check'][s % 4 + 1] AS Fee_Type, {PLANNED} AS Planned_Date, m, s % 3 <> 1 AS live, CASE WHEN s % 3 <> 1 THEN {LIVE} ELSE last_day({PLANNED}) END AS Budget_Date, tb
      FROM plan WHERE s % 10 <> 8),
    b1 AS (SELECT Channel_Name, AcctMgr, Fee_Type, Planned_Date, Budget_Date, sum(tb) AS Budget FROM b0 WHERE Budget_Date > DATE '1995-03-01' GROUP BY Channel_Name, AcctMgr, Fee_Type, Planned_Date, m, live, Budget_Date),
    per AS (SELECT *, {CLOSE} FROM b1)"""


def periods(spark, sf, form="status", sheet=None):
    sheet = A.budget_sheet(spark, sf) if sheet is None else sheet
    if form == "timeline":
        sheet = sheet.drop("Timeline").withColumnRenamed("Timeline_text", "Timeline")
    if form == "live_date":
        sheet = sheet.drop("Total_Budget").withColumnRenamed("Budget_text", "Total_Budget")
    return P.budget_periods(sheet, AS_OF, form, date(1995, 3, 1))


@query("append_partner_actions", """WITH a AS (SELECT *, o_orderdate + to_minutes(o_orderkey % 1440) AS tm FROM orders),
    r AS (SELECT CAST(o_orderkey AS VARCHAR) AS oid, tm, o_orderkey, b FROM a, (VALUES (0), (5)) v(b) WHERE b = 0 OR o_orderkey % 6 = 0)
    SELECT oid, strftime(tm, '%Y-%m-%d %H:%M:%S') AS action_date, strftime(tm - to_days(CAST(o_orderkey % 120 + b AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS click_date FROM r""")
def append_partner_actions(spark, sf):
    fresh = A.partner_actions(spark, sf)
    target = fresh.where("action_date < '1999-01-01'")
    return append_new(target, fresh.unionByName(fresh), "oid").select("oid", "action_date", "click_date")


@query("budget_sheet_refresh", f"""WITH {PLAN} SELECT 'Ch ' || s AS Channel_Name, {PLANNED} AS Date, tb AS Total_Budget, 'Mgr' || s % 3 AS Acct__Mgr_ FROM plan""")
def budget_sheet_refresh(spark, sf):
    clean = P.budget_clean(A.budget_sheet(spark, sf)).select("Channel_Name", "Date", "Total_Budget", "Acct__Mgr_")
    return overwrite(clean, clean)


@query("partner_medium_map", """SELECT 'Ch ' || s_suppkey AS Name, 'med' || s_suppkey AS Medium, 'Influencer' AS Type FROM supplier WHERE s_suppkey % 8 NOT IN (3, 7) AND s_suppkey % 3 = 0
    UNION ALL SELECT NULL, 'med' || s_suppkey, 'Influencer' FROM supplier WHERE s_suppkey % 8 = 3 AND s_suppkey % 3 = 0
    UNION ALL SELECT 'Partner ' || s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'gm' || s_suppkey ELSE 'P' || s_suppkey END, 'Affiliate' FROM supplier WHERE s_suppkey % 9 <> 4""")
def partner_medium_map(spark, sf):
    return P.medium_map(P.naming_clean(A.naming(spark, sf)), A.affiliate_naming(spark, sf))


@query("budget_periods", f"""WITH {PERIODS} SELECT Channel_Name, AcctMgr, Fee_Type, Planned_Date, Budget_Date, round(Budget, 2) AS Budget, ToDate FROM per""")
def budget_periods(spark, sf):
    return periods(spark, sf).withColumn("Budget", F.round("Budget", 2))


@query("budget_periods_text_dates", f"""WITH {PERIODS} SELECT Channel_Name, AcctMgr, Fee_Type, Planned_Date, Budget_Date, round(Budget, 2) AS Budget, ToDate FROM per""")
def budget_periods_text_dates(spark, sf):
    return periods(spark, sf, "timeline").withColumn("Budget", F.round("Budget", 2))


@query("budget_periods_live_date", f"""WITH {PLAN}, b1 AS (SELECT 'Ch ' || s AS Channel_Name, 'Mgr' || s % 3 AS AcctMgr, 'Flat' AS Fee_Type, {PLANNED} AS Planned_Date,
      CASE WHEN s % 3 <> 1 THEN {LIVE} ELSE last_day({PLANNED}) END AS Budget_Date, tb AS Budget FROM plan)
    SELECT Channel_Name, AcctMgr, Fee_Type, Planned_Date, Budget_Date, round(Budget, 2) AS Budget, ToDate FROM (SELECT *, {CLOSE} FROM (SELECT * FROM b1 WHERE Budget_Date > DATE '1995-03-01'))""")
def budget_periods_live_date(spark, sf):
    return periods(spark, sf, "live_date").withColumn("Budget", F.round("Budget", 2))


COSTS = """ac AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS Planned_Date, CAST(l_shipdate AS DATE) AS Budget_Date,
      CASE WHEN l_suppkey % 8 <> 3 THEN 'Ch ' || l_suppkey ELSE 'Media ' || l_suppkey END AS Channel_Name, round(l_extendedprice * l_discount, 4) AS action_cost,
      'Media ' || l_suppkey AS IR_Media_Name, 'Mgr' || l_suppkey % 3 AS AcctMgr FROM lineitem
    WHERE l_linenumber <> 1 AND l_shipdate >= DATE '1996-01-01' AND round(l_extendedprice * l_discount, 4) > 0 AND l_suppkey % 8 <> 7 AND l_suppkey > 1)"""


def costs(spark, sf):
    return P.action_costs(A.funnel_spend(spark, sf), P.naming_clean(A.naming(spark, sf)), SINCE)


@query("action_costs", f"WITH {COSTS} SELECT * FROM ac")
def action_costs(spark, sf):
    return costs(spark, sf)


@query("budget_with_actions", f"""WITH {PERIODS}, {COSTS},
    ex AS (SELECT ac.Channel_Name, ac.Budget_Date AS Action_Date, per.Budget_Date, ToDate, action_cost, ac.AcctMgr FROM ac LEFT JOIN per ON ac.Channel_Name = per.Channel_Name AND ac.Budget_Date BETWEEN per.Budget_Date AND ToDate),
    u AS (SELECT Channel_Name, 0.0::DOUBLE AS Budget, AcctMgr, CAST(date_trunc('month', Action_Date) AS DATE) AS Planned_Date, CAST(date_trunc('month', Action_Date) AS DATE) AS Budget_Date, 'Commission Only' AS Fee_Type, sum(action_cost) AS action_cost
        FROM ex WHERE Budget_Date IS NULL GROUP BY ALL
      UNION ALL SELECT per.Channel_Name, per.Budget, per.AcctMgr, per.Planned_Date, CASE WHEN per.Fee_Type = 'Commission Only' THEN per.Planned_Date ELSE per.Budget_Date END, per.Fee_Type, coalesce(g.c, 0)
        FROM per LEFT JOIN (SELECT Channel_Name, Budget_Date, ToDate, sum(action_cost) AS c FROM ex WHERE Budget_Date IS NOT NULL GROUP BY ALL) g ON g.Channel_Name = per.Channel_Name AND g.Budget_Date = per.Budget_Date AND g.ToDate = per.ToDate)
    SELECT Channel_Name, AcctMgr, Planned_Date, Budget_Date, Fee_Type, round(Budget, 2) AS Budget, round(action_cost, 4) AS action_cost, {CLOSE} FROM u""")
def budget_with_actions(spark, sf):
    out = P.budget_with_actions(stage(periods(spark, sf)), costs(spark, sf), AS_OF)
    return out.withColumn("Budget", F.round("Budget", 2)).withColumn("action_cost", F.round("action_cost", 4))


@query("shared_id", """SELECT DISTINCT 'Ch ' || l_suppkey AS Channel_Name, 'ch_' || l_suppkey AS sharedId FROM lineitem WHERE l_suppkey % 6 <> 0""")
def shared_id(spark, sf):
    known = A.table(spark, sf, "supplier").where("s_suppkey % 6 = 0").select(F.expr("'CH ' || s_suppkey").alias("Channel_Name"))
    return P.shared_id(A.budget_sheet(spark, sf), known)


ACT = """act0 AS (SELECT *, o_orderdate + to_minutes(o_orderkey % 1440) AS tm FROM orders),
    pa AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS oid, o_orderkey, o_custkey, tm, tm - to_days(CAST(o_orderkey % 120 AS INTEGER)) AS click,
      CASE left(o_orderpriority, 1) WHEN '1' THEN 'Creators-A' WHEN '2' THEN 'creatorsgm-B' ELSE 'Blog' END AS media,
      CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 'TEST100x' WHEN 2 THEN 'Trial1' ELSE 'SAVE' || o_orderkey % 3 END AS promo,
      CASE WHEN o_custkey % 10 <> 9 THEN 'CH_' || o_custkey % 10 END AS subid4 FROM act0),
    ch AS (SELECT DISTINCT 'Ch ' || l_suppkey AS Channel_Name, 'ch_' || l_suppkey AS sid FROM lineitem)"""
IRL = f"""irl AS (SELECT DISTINCT oid AS subscriber_id, CASE WHEN o_custkey % 11 < 8 THEN md5('u' || o_custkey || '@x') END AS subscriber_email, date_trunc('day', tm)::TIMESTAMP AS Datetime, subid4, Channel_Name, 'IR' AS Plat
    FROM pa LEFT JOIN ch ON lower(subid4) = sid WHERE media <> 'Blog' AND subid4 IS NOT NULL AND date_diff('day', click, tm) <= 90)"""
#: The lead table before the merge: addresses are out of date, and every fifth order's channel was not known.
OLD_IRL = """SELECT subscriber_id, 'x' AS subscriber_email, Datetime, subid4, CASE WHEN CAST(subscriber_id AS BIGINT) % 5 <> 0 THEN Channel_Name END AS Channel_Name, Plat FROM irl WHERE Datetime < TIMESTAMP '1997-01-01'"""


def shared(spark, sf):
    return P.shared_id(A.budget_sheet(spark, sf))


def leads(spark, sf, names=None):
    return P.partner_leads(A.partner_actions(spark, sf), A.shop_subscribers(spark, sf), shared(spark, sf) if names is None else names, A.naming(spark, sf), MEDIA)


@query("partner_leads", f"""WITH {ACT}, {IRL}, o AS ({OLD_IRL}), met AS (SELECT DISTINCT subscriber_id, lower(Channel_Name) AS c FROM o WHERE Channel_Name IS NOT NULL)
    SELECT irl.subscriber_id, CASE WHEN c IS NULL THEN irl.subscriber_email ELSE coalesce(irl.subscriber_email, 'x') END AS subscriber_email, irl.Datetime, irl.subid4, irl.Channel_Name, irl.Plat
      FROM irl LEFT JOIN met ON met.subscriber_id = irl.subscriber_id AND c = lower(Channel_Name)
    UNION ALL SELECT * FROM o WHERE Channel_Name IS NULL AND subscriber_id NOT IN (SELECT subscriber_id FROM irl WHERE Channel_Name IS NOT NULL)""")
def partner_leads(spark, sf):
    new = stage(leads(spark, sf))
    known = F.when(F.col("subscriber_id").cast("long") % 5 != 0, F.col("Channel_Name"))
    old = new.where("Datetime < timestamp_ntz'1997-01-01'").withColumns({"subscriber_email": F.lit("x"), "Channel_Name": known})
    return P.merge_leads(old, new, "Channel_Name")


ADM = """adm AS (SELECT o_orderkey AS subscriber_id, md5('u' || o_custkey || '@x') AS subscriber_email, date_trunc('day', o_orderdate + to_minutes(o_orderkey % 1440) - INTERVAL 8 HOUR)::TIMESTAMP AS Datetime,
    'code-batchA-' || o_custkey % 9 AS Affid, 'Admin' AS Plat FROM orders WHERE o_custkey % 11 < 8 AND o_custkey % 9 < 6 AND o_orderdate + to_minutes(o_orderkey % 1440) - INTERVAL 8 HOUR > TIMESTAMP '1996-01-01'
    AND 'code-batchA-' || o_custkey % 9 IN (SELECT 'code-batchA-' || s_suppkey % 7 FROM supplier WHERE s_suppkey % 8 <> 7 AND s_suppkey % 2 = 0))"""


def admin(spark, sf):
    return P.system_leads(A.shop_subscribers(spark, sf), A.affiliate_codes(spark, sf), A.naming(spark, sf), CODES, SINCE)


@query("system_leads", f"""WITH {ADM} SELECT * FROM adm UNION ALL SELECT -subscriber_id, 'x', Datetime, NULL, Plat FROM adm WHERE subscriber_id % 6 = 0""")
def system_leads(spark, sf):
    rows = stage(admin(spark, sf))
    # before: a third with an old address, half of these without a code; and subscribers who don't come again
    old = rows.where("subscriber_id % 3 = 0").withColumns({"subscriber_email": F.lit("x"), "Affid": F.expr("CASE WHEN subscriber_id % 6 <> 0 THEN Affid END")})
    gone = old.where("subscriber_id % 6 = 0").withColumn("subscriber_id", -F.col("subscriber_id"))
    return P.merge_leads(old.unionByName(gone), rows, "Affid")


DAYS = """days AS (SELECT DISTINCT Channel_Name, Budget_Date, ToDate FROM per UNION SELECT DISTINCT 'code-batchA-' || right(Channel_Name, 1), Budget_Date, ToDate FROM per WHERE Channel_Name LIKE 'Ch _')"""
COMBINED = f"""lc0 AS (SELECT DISTINCT subscriber_id, subscriber_email, Datetime, Channel_Name, Plat FROM irl WHERE subscriber_id NOT IN (SELECT CAST(subscriber_id AS VARCHAR) FROM adm)
      UNION ALL SELECT DISTINCT CAST(subscriber_id AS VARCHAR), subscriber_email, Datetime, Affid, Plat FROM adm WHERE CAST(subscriber_id AS VARCHAR) NOT IN (SELECT subscriber_id FROM irl)
      UNION ALL SELECT DISTINCT i.subscriber_id, a.subscriber_email, a.Datetime, i.Channel_Name, 'Both' FROM adm a JOIN irl i ON i.subscriber_id = CAST(a.subscriber_id AS VARCHAR)),
    lc AS (SELECT DISTINCT subscriber_id, subscriber_email, Datetime, lc0.Channel_Name, Plat, Budget_Date FROM lc0 JOIN days ON days.Channel_Name = lc0.Channel_Name AND CAST(Datetime AS DATE) BETWEEN Budget_Date AND ToDate)"""


def named_periods(spark, sf, sheet=None):
    per = stage(periods(spark, sf, sheet=sheet).select("Channel_Name", "Budget_Date", "ToDate"))
    own = per.where("Channel_Name like 'Ch _'").withColumn("Channel_Name", F.expr("'code-batchA-' || right(Channel_Name, 1)"))
    return stage(per.unionByName(own).distinct())


@query("leads_combined", f"""WITH {PERIODS}, {ACT}, {IRL}, {ADM}, {DAYS}, {COMBINED} SELECT * FROM lc UNION ALL
    SELECT 'gone-' || subscriber_id, subscriber_email, Datetime, Channel_Name, Plat, Budget_Date - 7 FROM lc WHERE Plat = 'Both'""")
def leads_combined(spark, sf):
    rows = stage(P.leads_combined(stage(leads(spark, sf)), stage(admin(spark, sf)), named_periods(spark, sf)))
    # before: other periods or none, and leads that don't come again
    late = rows.where("Plat <> 'IR'").withColumn("Budget_Date", F.expr("CASE WHEN Plat = 'Both' THEN date_sub(Budget_Date, 7) END"))
    gone = late.where("Plat = 'Both'").withColumn("subscriber_id", F.concat(F.lit("gone-"), "subscriber_id"))
    return P.merge_combined_leads(late.unionByName(gone), rows)


SUMS = "CAST(sum(Item_Qty_Ordered) AS BIGINT) AS items, round(sum(Item_Price), 2) AS Order_Full_Price, round(sum(ItemRevenue), 4) AS Revenue, round(sum(ItemRevenue) + sum(Item_Tax), 6) AS Revenue_Inc_Tax"
OKEYS = "CAST(Order_Number AS VARCHAR) AS Order_id, Store, Device, md5(lower(customer_email)) AS customer_email, Order_Coupon AS coupon_code, CAST(Creation_Datetime AS DATE) AS Date, Creation_Datetime AS Date_Time"
NO_TEST = "lower({0}) NOT LIKE 'test100%' AND lower({0}) NOT LIKE 'trial%'"
IRS = f"""irs AS (SELECT {OKEYS}, Channel_Name, Sale_type, {SUMS}, round(sum(Item_Tax), 6) AS Tax FROM (SELECT DISTINCT oid, Channel_Name, CASE WHEN date_diff('day', click, tm) <= 1 THEN 'C' ELSE 'P' END AS Sale_type FROM pa LEFT JOIN ch ON lower(subid4) = sid
      WHERE media <> 'Blog' AND subid4 IS NOT NULL AND {NO_TEST.format('promo')} AND click >= TIMESTAMP '1996-01-01') d JOIN items ON oid = CAST(Order_Number AS VARCHAR) GROUP BY ALL)"""


def rounded(df):
    # as many digits as the exact products have, so that no tie is rounded
    digits = {"Order_Full_Price": 2, "Revenue": 4, "Revenue_Inc_Tax": 6, "Tax": 6}
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


def sales(spark, sf, items=None, names=None):
    items, names = A.order_items(spark, sf) if items is None else items, shared(spark, sf) if names is None else names
    return rounded(P.partner_sales(A.partner_actions(spark, sf), items, names, MEDIA, TESTS, SINCE))


@query("partner_sales", f"""WITH {S.ITEMS}, {ACT}, {IRS} SELECT * FROM irs""")
def partner_sales(spark, sf):
    new = stage(sales(spark, sf))
    old = new.where("Date < date'1998-01-01'").withColumn("Sale_type", F.lit("X"))
    return P.merge_partner_sales(old, new)


ADS = f"""ads AS (SELECT {OKEYS}, affiliate_code AS Channel_Name, {SUMS} FROM items WHERE Creation_Datetime >= TIMESTAMP '1996-01-01' AND lower(affiliate_code) LIKE '%batcha%' AND {NO_TEST.format('Order_Coupon')} GROUP BY ALL)"""


def shop_sales(spark, sf, items=None):
    return rounded(P.system_sales(A.order_items(spark, sf) if items is None else items, CODES, TESTS, SINCE))


@query("system_sales", f"WITH {S.ITEMS}, {ADS} SELECT * FROM ads")
def system_sales(spark, sf):
    return shop_sales(spark, sf)


SALE = ", ".join(P.SALE)
SOLD = f"""sc0 AS (SELECT {SALE}, 'IR' AS Plat, Sale_type FROM irs WHERE Order_id NOT IN (SELECT Order_id FROM ads)
      UNION ALL SELECT {SALE}, 'Admin', 'C' FROM ads WHERE Order_id NOT IN (SELECT Order_id FROM irs)
      UNION ALL SELECT DISTINCT {', '.join('i.Channel_Name' if c == 'Channel_Name' else 'a.' + c for c in P.SALE)}, 'Both', 'C' FROM ads a JOIN irs i USING (Order_id)),
    sold AS (SELECT sc0.*, Budget_Date, '' AS Sub_Date FROM sc0 LEFT JOIN days ON days.Channel_Name = sc0.Channel_Name AND CAST(Date_Time AS DATE) BETWEEN Budget_Date AND ToDate)"""


def combined(spark, sf):
    return P.sales_combined(stage(sales(spark, sf)), stage(shop_sales(spark, sf)), named_periods(spark, sf))


def sales_before(rows):
    """The sales table before the merge: some orders without a period, some with another one, and some that don't come again."""
    late = rows.where("Plat <> 'IR'").withColumn("Budget_Date", F.expr("CASE WHEN Plat = 'Both' THEN date_sub(Budget_Date, 7) END"))
    gone = late.where("Plat = 'Both'").withColumn("Order_id", F.concat(F.lit("gone-"), "Order_id"))
    return late.unionByName(gone)


MERGED_SALES = f"""WITH {PERIODS}, {S.ITEMS}, {ACT}, {IRS}, {ADS}, {DAYS}, {SOLD} SELECT * FROM sold
    UNION ALL SELECT * REPLACE ('gone-' || Order_id AS Order_id, Budget_Date - 7 AS Budget_Date) FROM sold WHERE Plat = 'Both'"""


@query("sales_combined", MERGED_SALES)
def sales_combined(spark, sf):
    rows = stage(combined(spark, sf))
    return P.merge_sales(sales_before(rows), rows)


@query("sales_merge_by_month", MERGED_SALES)
def sales_merge_by_month(spark, sf):
    """The same in a folder partitioned by month: two years' sales come one after the other, and months without any are not read."""
    rows = stage(combined(spark, sf).withColumn("month", F.trunc("Date", "month")))
    path = stage_partitioned(sales_before(rows), "month")
    for part in ("Date < date'1998-01-01'", "Date >= date'1998-01-01'"):
        P.merge_sales_by_month(spark, path, rows.where(part))
    return spark.read.parquet(path).drop("month")


@query("converted_leads", f"""WITH {PERIODS}, {S.ITEMS}, {ACT}, {IRL}, {ADM}, {IRS}, {ADS}, {DAYS}, {COMBINED}, {SOLD},
    pe AS (SELECT subscriber_email AS customer_email, trim(Channel_Name) AS Channel_Name, max(Datetime) AS Sub_Date FROM lc GROUP BY ALL),
    od AS (SELECT {OKEYS}, {SUMS} FROM items WHERE lower(affiliate_code) NOT LIKE '%batcha%' AND Creation_Datetime >= TIMESTAMP '1996-01-01' GROUP BY ALL)
    SELECT DISTINCT od.Order_id, Store, Device, pe.Channel_Name, customer_email, coupon_code, Date, Date AS Date_Time, items, Order_Full_Price, Revenue, Revenue_Inc_Tax, Budget_Date, 'Conv Lead' AS Plat, Sub_Date, 'P' AS Sale_type
    FROM pe JOIN od USING (customer_email) LEFT JOIN days ON days.Channel_Name = pe.Channel_Name AND CAST(Sub_Date AS DATE) BETWEEN Budget_Date AND ToDate
    WHERE Sub_Date <= CAST(Date AS TIMESTAMP) AND NOT EXISTS (SELECT 1 FROM sold WHERE sold.Order_id = od.Order_id AND trim(sold.Channel_Name) = pe.Channel_Name)""")
def converted_leads(spark, sf):
    # what several steps read is built once: the sheet, the channels and the columns of the order items that they need
    sheet = stage(A.budget_sheet(spark, sf))
    names, per = stage(P.shared_id(sheet)), named_periods(spark, sf, sheet)
    items = stage(A.order_items(spark, sf).select("Order_Number", "Creation_Datetime", "customer_email", "Store", "Device", "Order_Coupon", "affiliate_code",
                                                  "New_Returning", "Item_Qty_Ordered", "Item_Price", "ItemRevenue", "Item_Tax"))
    people = stage(P.leads_combined(stage(leads(spark, sf, names)), stage(admin(spark, sf)), per))
    sold = stage(P.sales_combined(stage(sales(spark, sf, items, names)), stage(shop_sales(spark, sf, items)), per))
    rows = stage(rounded(P.converted_leads(people, items, sold, per, CODES, SINCE)))
    # before: a third of the rows as they are, which stay as they are
    return P.merge_converted(rows.where("CAST(Order_id AS BIGINT) % 3 = 0"), rows)


@query("code_sheet_row", """SELECT s_suppkey AS entity_id, CASE WHEN s_suppkey % 9 < 6 THEN 'code-batchA-' ELSE 'code-other-' END || s_suppkey AS code FROM supplier ORDER BY code, entity_id LIMIT 1 OFFSET 2""")
def code_sheet_row(spark, sf):
    """The third row of the code sheet."""
    return nth_row(A.affiliate_codes(spark, sf), ["code", "entity_id"], 3)
