"""Subscription status over time: first subscription, change log, monthly status, movement, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import month_start, pseudonym
from ..sources.shards import scan_ingested
from .email import as_datetime, with_offset
from .relational import not_in


def _change_times(activity: DataFrame, offsets: DataFrame) -> DataFrame:
    """Lower-case address, status and local time of each change; the UTC time stays as ``ts``."""
    raw = activity.select(F.lower("channels_email_address").alias("subscriber_email"),
                          F.col("channels_email_subscribeStatus").alias("status"), "ingest_ts",
                          as_datetime(F.coalesce("channels_email_subinfo_ts", "channels_email_unsubinfo_ts")).alias("ts"))
    return with_offset(raw, "ts", offsets, {"UTC_2_PST": "local"})


def subscriber_creation(shop: DataFrame, activity: DataFrame, offsets: DataFrame, known: DataFrame, since: date) -> DataFrame:
    """First subscription time of addresses not yet known: the shop system first, the e-mail platform second.

    Each address gets one row, its earliest time within the window.
    """
    first = shop.where((F.col("status_name") == "SUBSCRIBED") & (F.col("change_status_at") >= F.lit(since.isoformat()).cast("timestamp_ntz")))
    first = not_in(first.select(F.lower("subscriber_email").alias("subscriber_email"), "change_status_at"),
                   F.col("subscriber_email"), known.select(F.lower("subscriber_email").alias("e")))
    first = first.groupBy("subscriber_email").agg(F.min("change_status_at").cast("timestamp_ntz").alias("Datetime_Created"))
    second = _change_times(scan_ingested(activity, since), offsets)
    second = not_in(second, F.col("subscriber_email"), known.select(F.lower("subscriber_email").alias("e")))
    second = not_in(second, F.col("subscriber_email"), first.select("subscriber_email"))
    second = second.groupBy("subscriber_email").agg(F.min("local").alias("Datetime_Created"))
    return first.unionByName(second)


def status_change_log(activity: DataFrame, offsets: DataFrame, created: DataFrame, since: date) -> DataFrame:
    """Last change per address, local day and direction, for addresses with a creation date.

    The direction follows the status itself and both directions are moved to local time.
    """
    moves = _change_times(activity, offsets).where(F.to_date("ts") >= F.lit(since))
    known = created.select(F.lower("subscriber_email").alias("subscriber_email")).distinct()
    change = F.when(F.col("status") == "subscribed", "SUB").when(F.col("status") == "unsubscribed", "UNSUB")
    rows = moves.withColumn("Change_to", change).where("Change_to is not null").join(known, "subscriber_email", "left_semi")
    return (rows.groupBy("subscriber_email", F.to_date("local").alias("d"), "Change_to")
            .agg(F.max("local").alias("Datetime_Changed")).select("subscriber_email", "Datetime_Changed", "Change_to"))


def product_class() -> Column:
    return (F.when(F.col("EyewearType") == "Contact Lenses", "Contact Lenses")
            .when(F.col("EyewearType").isin("Product Upgrade", "Accessories"), "Other").otherwise("Eyeglasses"))


def monthly_status(items: DataFrame, created: DataFrame, changes: DataFrame, as_of: date, product: str | Sequence[str] | None = None) -> DataFrame:
    """For each customer and month since the first order: last status and whether subscribed in the month.

    The status of a month is the last change up to its end. Changes shrink to one row per
    customer and month, each of which holds until the next; the first order meets these spans,
    and only then are they spread over their months, so the months are not shuffled.
    ``product`` restricts customers to buyers of one class; several classes are read in one
    pass, and each customer comes once per class, named in ``audience``.
    """
    bought = items.where(F.lower("customer_email") != "")
    classes = [] if product is None else [product] if isinstance(product, str) else list(product)
    audience = [product_class().alias("audience")] if classes else []
    if classes:
        bought = bought.where(product_class().isin(classes))
    first = bought.groupBy(F.lower("customer_email").alias("customer_email"), *audience).agg(F.min(month_start("Creation_Datetime")).alias("Order_date"))
    moves = created.select(F.lower("subscriber_email").alias("customer_email"), F.col("Datetime_Created").alias("at"),
                           F.lit("Active").alias("to")).unionByName(
        changes.select(F.lower("subscriber_email").alias("customer_email"), F.col("Datetime_Changed").alias("at"),
                       F.when(F.col("Change_to") == "SUB", "Active").otherwise("inActive").alias("to")))
    monthly = moves.where("at is not null").groupBy("customer_email", month_start("at").alias("from")).agg(
        F.max(F.struct("at", "to"))["to"].alias("to"), F.max(F.when(F.col("to") == "Active", True)).alias("Was_Sub"))
    along = Window.partitionBy("customer_email").orderBy("from")
    spans = monthly.withColumns({"until": F.lead("from").over(along), "earlier": F.lag("from").over(along)})
    own = F.struct("from", "until", "to", "Was_Sub")
    ahead = F.struct(F.lit(None).cast("date").alias("from"), F.col("from").alias("until"), F.lit(None).cast("string").alias("to"), F.lit(None).cast("boolean").alias("Was_Sub"))
    spans = spans.select("customer_email", F.inline(F.when(F.col("earlier").isNull(), F.array(ahead, own)).otherwise(F.array(own))))
    now = F.lit(as_of.replace(day=1))
    known = first.join(spans, "customer_email", "left").withColumns({
        "start": F.greatest("Order_date", "from"), "end": F.least(F.add_months("until", -1), now)}).where("start <= end")
    filled = known.select("*", F.explode(F.sequence("start", "end", F.expr("interval 1 month"))).alias("MonthID"))
    kept = ["audience"] if classes and not isinstance(product, str) else []
    return filled.select("customer_email", *kept, "Order_date", "MonthID", F.coalesce("to", F.lit("inActive")).alias("Last_Status_in_month"),
                         F.when(F.col("MonthID") == F.col("from"), F.col("Was_Sub")).alias("Was_Sub"))


def monthly_changed() -> Column:
    """Merge condition: the status differs, or the flag does (unknown counts as true)."""
    return ((F.col("t_Last_Status_in_month") != F.col("s_Last_Status_in_month"))
            | (F.coalesce("t_Was_Sub", F.lit(True)) != F.coalesce("s_Was_Sub", F.lit(True))))


def active_movement(status: DataFrame, since: date, until: date) -> DataFrame:
    """Active and inactive customers per audience and month against the month before.

    The window runs over the monthly totals only, one row per audience and month.
    """
    active = F.col("Last_Status_in_month") == "Active"
    months = status.where(F.col("MonthID").between(F.lit(since), F.lit(until.replace(day=1)))).groupBy("audience", "MonthID").agg(
        F.sum(F.when(active, 1).otherwise(0)).alias("Active"), F.sum(F.when(active, 0).otherwise(1)).alias("Inactive"))
    before = Window.partitionBy("audience").orderBy(F.col("MonthID").desc())
    out = months.withColumn("Open_active", F.lead("Active").over(before)).withColumn("Open_inactive", F.lead("Inactive").over(before))
    a, i = F.col("Active") - F.col("Open_active"), F.col("Inactive") - F.col("Open_inactive")
    return out.select("audience", "MonthID", (F.col("Active") + F.col("Inactive")).alias("Total"), "Active", "Open_active",
                      a.alias("Active_diff"), "Inactive", "Open_inactive", i.alias("Inactive_diff"), (a + i).alias("Delta"))


# Message categories that run automatically for contact-lens customers.
AUTO_CATEGORIES = ["Cart Abandon", "Product Abandon", "Category Abandon", "Post Purchase Contact Lenses", "Welcome"]


def mail_segment(category: Column, name: Column) -> Column:
    name = F.lower(name)
    return (F.when(category.isin(AUTO_CATEGORIES) & name.contains("contact"), "Auto")
            .when(name.contains("pps-contact"), "Auto")
            .when(category == "Contacts Cashback Reorder", "Reorder")
            .when(name.like("%re-order_series_contacts%"), "Reorder")
            .when(category.contains("Contact"), "Newsletter Contacts")
            .otherwise("Eyeglasses Emails"))


def retention_revenue(credited: Sequence[DataFrame], items: DataFrame, contact_orders: DataFrame, final_names: DataFrame,
                      categories: DataFrame, since: date, until: date) -> DataFrame:
    """Credited orders with message segment, contact-lens and other revenue, new or returning, cohort date.

    ``contact_orders`` ranks the contact-lens orders of each customer; rank 1 gives the cohort
    date. Rows without a final message name are left out. Addresses leave as digests.
    """
    lo, hi = F.lit(since).cast("timestamp_ntz"), F.lit(until).cast("timestamp_ntz")
    ranks = contact_orders.select(F.lower("customer_email").alias("e"), F.col("Order_Number").alias("o"), "Rank").distinct()
    cohort = contact_orders.where("Rank = 1").select(F.lower("customer_email").alias("c"), F.col("Creation_Datetime").alias("Cohort_Date")).distinct()
    contacts = F.col("FrameType") == "Contact Lenses"
    orders = items.where(F.col("Creation_Datetime").between(lo, hi)).groupBy(
        F.lower("customer_email").alias("om"), "Order_Number", F.col("New_Returning").alias("New_Ret_Total")).agg(
        F.sum(F.when(contacts, F.col("ItemRevenue")).otherwise(0.0)).alias("Contacts_Revenue"),
        F.sum(F.when(~contacts, F.col("ItemRevenue")).otherwise(0.0)).alias("Glasses_Revenue"))
    orders = (orders.join(ranks, (F.col("om") == F.col("e")) & (F.col("Order_Number") == F.col("o")), "left")
              .join(cohort, F.col("om") == F.col("c"), "left")
              .withColumn("New_Ret", F.when(F.col("Rank") > 1, "Return").otherwise("New"))
              .withColumn("oid", F.col("Order_Number").cast("string")).drop("e", "o", "c", "Order_Number", "Rank"))
    clicks = None
    for df in credited:
        rows = df.where(F.col("ActionDateTime").between(lo, hi)).select(
            F.to_date("ActionDateTime").alias("Date"), "EmailAddress", "linkUrl", "Order_id", "MessageName")
        clicks = rows if clicks is None else clicks.unionByName(rows)
    names = final_names.where("Final_message_name is not null").select(F.lower("message_name").alias("n"), "Final_message_name").distinct()
    cats = categories.select(F.col("Final_message_name").alias("f"), "Newsletter_Category").distinct()
    out = (clicks.join(orders, (F.lower("EmailAddress") == F.col("om")) & (F.col("Order_id") == F.col("oid")), "left")
           .join(names, F.lower("MessageName") == F.col("n"))
           .join(cats, F.col("Final_message_name") == F.col("f"), "left"))
    return out.select(
        F.col("Date").alias("Date_Time"), "Date", pseudonym("EmailAddress").alias("EmailAddress"), "Final_message_name",
        "Newsletter_Category", mail_segment(F.col("Newsletter_Category"), F.col("Final_message_name")).alias("Newsletter_Segment"),
        "Contacts_Revenue", "Glasses_Revenue", "New_Ret", "New_Ret_Total", "Cohort_Date")
