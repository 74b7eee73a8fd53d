"""Partner jobs: budgets and their periods, action costs, leads, sales and converted leads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import diff_boundary, item, money_text, month_start, pseudonym, split_literal
from ..sources.targets import merge, merge_partitions, stage
from .ordered import neighbours
from .relational import join_intervals, latest_per_group, not_in, semi_in, split_sources


def like_any(c: Column | str, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE of any pattern; null when the text is null."""
    text = F.lower(c)
    return reduce(lambda a, b: a | b, [text.like(p) for p in patterns])


def like_none(c: Column | str, patterns: Sequence[str]) -> Column:
    """No pattern matches; a null text gives null, so the row drops out of a filter."""
    text = F.lower(c)
    return reduce(lambda a, b: a & b, [~text.like(p) for p in patterns])


# ---- budgets

def planned_date() -> Column:
    """First day of the planned month from a year and an English month name; bad text gives null."""
    return F.expr("try_to_date(concat(Planned_Year, Planned_Month, '01'), 'yyyyMMMMdd')")


def budget_clean(sheet: DataFrame) -> DataFrame:
    """Sheet rows with a trimmed channel name and the planned month as a date."""
    return sheet.withColumn("Channel_Name", F.trim("Channel_Name")).withColumn("Date", planned_date())


def naming_clean(naming: DataFrame) -> DataFrame:
    return naming.withColumn("Influence_Name", F.trim("Influence_Name"))


def medium_map(naming: DataFrame, affiliates: DataFrame) -> DataFrame:
    """Analytics medium of influencers (where known) and affiliates (partner name when missing)."""
    people = naming.where("D_name is not null").select(F.col("Influence_Name").alias("Name"), F.col("D_name").alias("Medium"),
                                                      F.lit("Influencer").alias("Type"))
    partners = affiliates.where("Partner is not null").select(
        F.col("Partner").alias("Name"), F.coalesce("GA_Medium", "IR_Partner_Name").alias("Medium"), F.lit("Affiliate").alias("Type"))
    return people.unionByName(partners)


def fee_type(fee: Column | str) -> Column:
    """Fee class from free text."""
    text = F.lower(fee)
    share, comm, flat = text.contains("revsh"), text.contains("comm"), text.contains("flat")
    return (F.when((share | comm) & flat, "Flat + Commission").when(comm | share, "Commission Only")
            .when(flat, "Flat").otherwise("check"))


def dotted_date(text: Column) -> Column:
    """``d.m.yy`` text to a date, null when it is none; 69 to 99 are of the last century."""
    parts = split_literal(text, ".")
    century = F.when(item(parts, 2).try_cast("int") >= 69, "19").otherwise("20")
    iso = F.concat(century, F.lpad(item(parts, 2), 2, "0"), F.lit("-"), F.lpad(item(parts, 1), 2, "0"), F.lit("-"), F.lpad(item(parts, 0), 2, "0"))
    return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")


ORDER = ["Budget_Date", "Planned_Date", "Fee_Type", "AcctMgr", "Budget"]


def _close_periods(df: DataFrame, as_of: date) -> DataFrame:
    """Period end: month end for commission only, else the day before the channel's next period, else yesterday."""
    following = neighbours(df, ["Channel_Name"], F.year("Budget_Date"), ORDER, F.date_sub("Budget_Date", 1), after="next")
    end = F.when(F.col("Fee_Type") == "Commission Only", F.last_day("Budget_Date")).otherwise(
        F.coalesce("next", F.date_sub(F.lit(as_of), 1)))
    return following.withColumn("ToDate", end).drop("next")


def budget_periods(budget: DataFrame, as_of: date, form: str = "status", since: date = date(2017, 1, 1)) -> DataFrame:
    """Budget per channel with the period it covers.

    A live row starts on its own date, any other on the last day of its planned month. The
    date is the ISO ``Timeline`` of rows with status live (``status``), a ``d.m.yy`` timeline
    (``timeline``) or ``Live_date`` (``live_date``, flat fee, budget as text). Rows with the
    same start are ordered by planned date, fee class, manager and budget.
    """
    df = budget.withColumn("Planned_Date", planned_date())
    if form == "live_date":
        df = df.where(F.col("Channel_Name").isNotNull() & ~F.col("Channel_Name").contains("Budget"))
        name, manager, fee = F.trim("Channel_Name"), F.col("Acct__Mgr_"), F.lit("Flat")
        own, line = F.col("Live_date").try_cast("date"), F.col("Live_date")
        amount = money_text("Total_Budget")
    else:
        df = df.where(F.lower("Type").isin("influencers", "ltb"))
        shared = F.col("Type") == "LTB"
        name = F.when(shared, "LTB").otherwise(F.trim("Channel_Name"))
        manager, fee = F.when(shared, "LTB").otherwise(F.col("Acct__Mgr_")), fee_type("Fee")
        line, amount = F.trim("Timeline"), F.col("Total_Budget")
        if form == "status":
            own = F.when(F.lower("Status") == "live", F.col("Timeline").try_cast("date"))
        else:
            own = F.when(F.length(line) <= 8, dotted_date(line))
    live = {"live_date": F.col("Live_date").isNotNull(), "status": F.lower("Status") == "live"}.get(form, F.length(F.trim("Timeline")) <= 8)
    start = F.when(live, own).otherwise(F.last_day("Planned_Date"))
    rows = df.groupBy(name.alias("Channel_Name"), "Planned_Month", "Planned_Year", line.alias("line"), "Planned_Date",
                      manager.alias("AcctMgr"), fee.alias("Fee_Type"), start.alias("Budget_Date")).agg(F.sum(amount).alias("Budget"))
    rows = rows.where(F.col("Budget_Date") > F.lit(since)).drop("Planned_Month", "Planned_Year", "line")
    return _close_periods(rows, as_of)


def action_costs(spend: DataFrame, naming: DataFrame, since: date = date(2019, 1, 1)) -> DataFrame:
    """Distinct positive action costs of named partners."""
    names = naming.where("IR_Media_Name is not null").select("IR_Media_Name", "Influence_Name", "AcctMgr").distinct()
    rows = spend.where(F.col("impact_type").isNotNull() & (F.col("Date") >= F.lit(since)) & (F.col("impact_action_cost") > 0))
    rows = rows.select("Date", "impact_media", "impact_action_cost").distinct().join(names, F.col("impact_media") == F.col("IR_Media_Name"))
    return rows.select(month_start("Date").alias("Planned_Date"), F.col("Date").alias("Budget_Date"),
                       F.coalesce("Influence_Name", "impact_media").alias("Channel_Name"), F.col("impact_action_cost").alias("action_cost"),
                       "IR_Media_Name", "AcctMgr").distinct()


def in_period(rows: DataFrame, periods: DataFrame, name: str, day: str, how: str = "left") -> DataFrame:
    """Join dated rows to the periods of the same name that hold the date.

    The distinct names and days find their periods by blocks of days, so long and open-ended periods cost no more than short
    ones; the rows then meet them by name and day, and a name with many rows is split by day. The rows are read three times and staged.
    """
    rows = stage(rows)
    asked = rows.select(F.col(name).alias("__n"), F.to_date(day).alias("__d")).where("__n IS NOT NULL").distinct()
    found = join_intervals(asked, periods.withColumnRenamed("Channel_Name", "__n"), ["__n"], "__d", "Budget_Date", "ToDate")
    return rows.join(found, (F.col(name) == F.col("__n")) & (F.to_date(day) == F.col("__d")), how).drop("__n", "__d")


def budget_with_actions(periods: DataFrame, costs: DataFrame, as_of: date) -> DataFrame:
    """Periods with the action costs that fall into them; other costs become monthly commission-only rows."""
    acts = costs.select("Channel_Name", F.col("Budget_Date").alias("Action_Date"), "action_cost", "AcctMgr")
    placed = in_period(acts, periods.select("Channel_Name", "Budget_Date", "ToDate"), "Channel_Name", "Action_Date")
    beyond = F.col("Budget_Date").isNull()
    # costs within a period have neither manager nor month of their own, so one pass sums both kinds
    sums = stage(placed.groupBy("Channel_Name", "Budget_Date", "ToDate", F.when(beyond, F.col("AcctMgr")).alias("AcctMgr"),
                                F.when(beyond, month_start("Action_Date")).alias("Planned_Date")).agg(F.sum("action_cost").alias("action_cost")))
    inside = sums.where(~beyond).drop("AcctMgr", "Planned_Date")
    commission = F.col("Fee_Type") == "Commission Only"
    known = periods.join(inside, ["Channel_Name", "Budget_Date", "ToDate"], "left").select(
        "Channel_Name", "Budget", "AcctMgr", "Planned_Date", F.when(commission, F.col("Planned_Date")).otherwise(F.col("Budget_Date")).alias("Budget_Date"),
        "Fee_Type", F.coalesce("action_cost", F.lit(0.0)).alias("action_cost"))
    outside = sums.where(beyond).select("Channel_Name", F.lit(0.0).alias("Budget"), "AcctMgr", "Planned_Date", F.col("Planned_Date").alias("Budget_Date"),
                                        F.lit("Commission Only").alias("Fee_Type"), "action_cost")
    return _close_periods(stage(outside.unionByName(known)), as_of)


# ---- leads and sales

def shared_id(names: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Channel names with their link slug, those already known left out."""
    name = F.trim("Channel_Name")
    slug = F.lower(F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("."), F.lit("_")))
    rows = names.select(name.alias("Channel_Name"), slug.alias("sharedId")).distinct()
    return rows if known is None else not_in(rows, F.lower("Channel_Name"), known.select(F.lower("Channel_Name").alias("n")))


def _day(c: str) -> Column:
    return F.to_date(c).cast("timestamp_ntz")


def _channels(shared: DataFrame) -> DataFrame:
    return shared.select(F.lower("sharedId").alias("__s"), "Channel_Name").distinct()


def partner_leads(leads: DataFrame, subscribers: DataFrame, shared: DataFrame, naming: DataFrame, media: Sequence[str], days: int = 90) -> DataFrame:
    """Leads of the watched media at their latest click day, acted on within ``days`` days; address hashed once."""
    own = leads.where(like_any("media", media)).select("oid", _day("action_date").alias("action_date"), _day("click_date").alias("click_date"),
                                                       F.trim("media").alias("media"), "subid4").where("subid4 is not null").distinct()
    own = latest_per_group(own, ["oid", "media", "subid4"], "click_date")
    own = semi_in(own, F.col("media"), naming.select(F.trim("IR_Media_Name").alias("m")))
    own = own.where(diff_boundary("DAY", "action_date", "click_date") <= days)
    mails = subscribers.select(F.col("subscriber_id").cast("string").alias("__id"), "subscriber_email").distinct()
    out = (own.join(mails, F.col("oid") == F.col("__id"), "left").join(_channels(shared), F.lower("subid4") == F.col("__s"), "left"))
    return out.select(F.col("oid").alias("subscriber_id"), pseudonym("subscriber_email").alias("subscriber_email"),
                      F.col("action_date").alias("Datetime"), "subid4", "Channel_Name", F.lit("IR").alias("Plat")).distinct()


def merge_leads(target: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """Insert new leads, renew a changed address, and drop target rows without ``name`` of subscribers that come again with one.

    A name is compared without regard to case. A null name equals none, so the evident intent needs a second step: an old row without a name
    meets the new rows by subscriber alone and leaves if there is one.
    """
    named, nameless = target.where(F.col(name).isNotNull()), target.where(F.col(name).isNull())
    kept = merge(nameless, rows.where(F.col(name).isNotNull()).select("subscriber_id").distinct(), ["subscriber_id"],
                 update_when=F.lit(False), delete_when=F.col(f"t_{name}").isNull(), insert=False)
    renewed = merge(named, rows, ["subscriber_id"], lower=[name], update=["subscriber_email"], update_when=F.col("t_subscriber_email") != F.col("s_subscriber_email"))
    return renewed.unionByName(kept)


def system_leads(subscribers: DataFrame, affiliates: DataFrame, naming: DataFrame, codes: Sequence[str], since: date) -> DataFrame:
    """Leads by the shop's own affiliate code; the day is eight hours behind UTC all year."""
    local = F.col("change_status_at").cast("timestamp_ntz") - F.expr("interval 8 hours")
    code = affiliates.where(like_any("code", codes)).select(F.col("entity_id").alias("affiliate_id"), "code").distinct()
    rows = subscribers.join(code, "affiliate_id").where(local > F.lit(since).cast("timestamp_ntz"))
    rows = semi_in(rows, F.col("code"), naming.select("Affid"))
    return rows.select("subscriber_id", pseudonym("subscriber_email").alias("subscriber_email"), F.to_date(local).cast("timestamp_ntz").alias("Datetime"),
                       F.col("code").alias("Affid"), F.lit("Admin").alias("Plat"))


def leads_combined(partner: DataFrame, system: DataFrame, periods: DataFrame) -> DataFrame:
    """Leads of the partner only, the system only and of both, placed into a budget period."""
    left = partner.select("subscriber_id", "subscriber_email", "Datetime", F.trim("Channel_Name").alias("Channel_Name"), "Plat")
    right = system.select(F.col("subscriber_id").cast("string").alias("subscriber_id"), "subscriber_email", "Datetime",
                          F.trim("Affid").alias("Channel_Name"), "Plat")
    only_left, only_right, _ = split_sources(left, right, "subscriber_id")
    both = right.drop("Channel_Name", "Plat").join(left.select("subscriber_id", "Channel_Name").distinct(), "subscriber_id").withColumn("Plat", F.lit("Both"))
    rows = only_left.distinct().unionByName(only_right.distinct()).unionByName(both.distinct())
    days = periods.select("Channel_Name", "Budget_Date", "ToDate").distinct()
    placed = in_period(rows.where("Channel_Name is not null"), days, "Channel_Name", "Datetime", "inner")
    return placed.select("subscriber_id", "subscriber_email", "Datetime", "Channel_Name", "Plat", "Budget_Date").distinct()


def period_changed() -> Column:
    return (F.col("t_Budget_Date") != F.col("s_Budget_Date")) | F.col("t_Budget_Date").isNull()


def merge_combined_leads(target: DataFrame, rows: DataFrame) -> DataFrame:
    return merge(target, rows, ["Plat"], nullsafe=["subscriber_id", "Channel_Name"], update=["Budget_Date"], update_when=period_changed())


def order_sums(items: DataFrame, *keys: Column | str) -> DataFrame:
    return items.groupBy(*keys).agg(
        F.sum("Item_Qty_Ordered").cast("long").alias("items"), F.sum("Item_Price").alias("Order_Full_Price"), F.sum("ItemRevenue").alias("Revenue"),
        (F.sum("ItemRevenue") + F.sum("Item_Tax")).alias("Revenue_Inc_Tax"), F.sum("Item_Tax").alias("Tax"))


def _order_keys() -> list[Column]:
    return [F.col("Order_Number").cast("string").alias("Order_id"), F.col("Store"), F.col("Device"), pseudonym("customer_email").alias("customer_email"),
            F.col("Order_Coupon").alias("coupon_code"), F.to_date("Creation_Datetime").alias("Date"),
            F.col("Creation_Datetime").cast("timestamp_ntz").alias("Date_Time")]


def partner_sales(sales: DataFrame, items: DataFrame, shared: DataFrame, media: Sequence[str], test_coupons: Sequence[str], since: date) -> DataFrame:
    """Sales of the watched media at their latest click with order sums; ``C`` if the click is at most a day old, else ``P``.

    Orders are summed before they meet the sales; sales without a coupon or with a test coupon drop out.
    """
    own = sales.select("oid", "promo_code", "revenue", F.col("action_date").cast("timestamp_ntz").alias("action_date"),
                       F.col("click_date").cast("timestamp_ntz").alias("click_date"), F.trim("media").alias("media"),
                       "subid1", "subid2", "subid3", "subid4").where("subid4 is not null").distinct()
    # the latest click counts among all rows of a sale, also those filtered below
    own = latest_per_group(own, ["oid", "media", "subid4"], "click_date")
    own = own.where(like_any("media", media) & like_none("promo_code", test_coupons) & (F.col("click_date") >= F.lit(since).cast("timestamp_ntz")))
    kind = F.when(diff_boundary("DAY", "action_date", "click_date") <= 1, "C").otherwise("P")
    own = own.join(_channels(shared), F.lower("subid4") == F.col("__s"), "left").withColumn("Sale_type", kind)
    # several distinct actions of one order repeat its items
    times = own.groupBy("oid", "Channel_Name", "Sale_type").agg(F.count(F.lit(1)).alias("k"))
    out = times.join(order_sums(items, *_order_keys()), F.col("oid") == F.col("Order_id"))
    sums = ["items", "Order_Full_Price", "Revenue", "Revenue_Inc_Tax", "Tax"]
    return out.select("Order_id", "Store", "Device", "Channel_Name", "customer_email", "coupon_code", "Date", "Date_Time", "Sale_type",
                      *[(F.col(c) * F.col("k")).alias(c) for c in sums])


def merge_partner_sales(target: DataFrame, rows: DataFrame) -> DataFrame:
    return merge(target, rows, ["Order_id", "Channel_Name"], update=["Sale_type"], update_when=F.col("t_Sale_type") != F.col("s_Sale_type"))


def system_sales(items: DataFrame, codes: Sequence[str], test_coupons: Sequence[str], since: date) -> DataFrame:
    """Orders by the shop's own affiliate codes with their sums; test coupons and orders without coupon drop out."""
    rows = items.where((F.to_date("Creation_Datetime") >= F.lit(since)) & like_any("affiliate_code", codes) & like_none("Order_Coupon", test_coupons))
    return order_sums(rows, *_order_keys(), F.col("affiliate_code").alias("Channel_Name")).drop("Tax")


SALE = ["Order_id", "Store", "Device", "Channel_Name", "customer_email", "coupon_code", "Date", "Date_Time", "items", "Order_Full_Price",
        "Revenue", "Revenue_Inc_Tax"]


def sales_combined(partner: DataFrame, system: DataFrame, periods: DataFrame) -> DataFrame:
    """Sales of the partner only, the system only and of both, with the budget period they fall into."""
    known_p, known_s = partner.select("Order_id").distinct(), system.select("Order_id").distinct()
    only_p = partner.join(known_s, "Order_id", "left_anti").select(*SALE, F.lit("IR").alias("Plat"), "Sale_type").distinct()
    only_s = system.join(known_p, "Order_id", "left_anti").select(*SALE, F.lit("Admin").alias("Plat"), F.lit("C").alias("Sale_type")).distinct()
    both = system.drop("Channel_Name").join(partner.select("Order_id", "Channel_Name").distinct(), "Order_id").select(
        *SALE, F.lit("Both").alias("Plat"), F.lit("C").alias("Sale_type")).distinct()
    trimmed = only_s.unionByName(both).withColumn("Channel_Name", F.trim("Channel_Name"))
    days = periods.select("Channel_Name", "Budget_Date", "ToDate").distinct()
    out = in_period(only_p.unionByName(trimmed), days, "Channel_Name", "Date_Time")
    return out.select(*SALE, "Budget_Date", "Plat", "Sale_type", F.lit("").alias("Sub_Date"))


def merge_sales(target: DataFrame, rows: DataFrame) -> DataFrame:
    return merge(target, rows, ["Order_id", "Channel_Name"], update=["Budget_Date"], update_when=period_changed())


def merge_sales_by_month(spark: SparkSession, path: str, rows: DataFrame) -> list:
    """``merge_sales`` into a folder partitioned by ``month``; the order's date fixes the month, so only the months of ``rows`` are touched."""
    return merge_partitions(spark, path, rows, ["Order_id", "Channel_Name", "month"], "month", update=["Budget_Date"], update_when=period_changed())


def converted_leads(leads: DataFrame, items: DataFrame, sales: DataFrame, periods: DataFrame, codes: Sequence[str], since: date) -> DataFrame:
    """Orders of leads on or after their last lead day that are not sales of the same channel already.

    Lead addresses are digests and are compared as such. Orders without an affiliate code
    drop out, as a null fails the test on codes.
    """
    people = leads.groupBy(F.col("subscriber_email").alias("customer_email"), F.trim("Channel_Name").alias("Channel_Name")).agg(F.max("Datetime").alias("Sub_Date"))
    rows = items.where(like_none("affiliate_code", codes) & (F.to_date("Creation_Datetime") >= F.lit(since)))
    orders = order_sums(rows, *_order_keys(), "New_Returning").drop("Tax", "New_Returning")
    out = people.join(orders, "customer_email").where(F.col("Sub_Date") <= F.col("Date").cast("timestamp_ntz"))
    done = sales.select("Order_id", F.trim("Channel_Name").alias("Channel_Name")).distinct()
    out = out.join(done, ["Order_id", "Channel_Name"], "left_anti")
    days = periods.select(F.trim("Channel_Name").alias("Channel_Name"), "Budget_Date", "ToDate").distinct()
    out = in_period(out, days, "Channel_Name", "Sub_Date")
    return out.select("Order_id", "Store", "Device", "Channel_Name", "customer_email", "coupon_code", "Date", F.col("Date").alias("Date_Time"), "items",
                      "Order_Full_Price", "Revenue", "Revenue_Inc_Tax", "Budget_Date", F.lit("Conv Lead").alias("Plat"), "Sub_Date",
                      F.lit("P").alias("Sale_type")).distinct()


def merge_converted(target: DataFrame, rows: DataFrame) -> DataFrame:
    return merge(target, rows, ["customer_email", "Order_id", "Channel_Name"], nullsafe=["Budget_Date"], update=["Budget_Date"], update_when=period_changed())
