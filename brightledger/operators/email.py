"""E-mail jobs: message facts, click-to-order credit, message funnels, tests, as-of lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import from_micros, epoch_micros, item, pseudonym, split_literal, trunc_hour
from ..sources.targets import newer_than, stage
from .ordered import earliest_within, last_before, running
from .relational import not_in, semi_in

SEGMENTS = ["noOfOrders", "daySinceLastOrder", "productType", "lensType", "brandType"]
NO_TAGS = '["None"]'  # fixed value: tag text of an untagged message


def as_datetime(text: str | Column) -> Column:
    return (F.col(text) if isinstance(text, str) else text).try_cast("timestamp_ntz")


def add_hours(ts: Column, hours: Column) -> Column:
    return from_micros(epoch_micros(ts) + hours.cast("long") * 3_600_000_000)


def with_offset(df: DataFrame, ts: str, offsets: DataFrame, zones: Mapping[str, str]) -> DataFrame:
    """Local times by a table of hour offsets per UTC date; dates not listed give null."""
    o = offsets.select(F.col("Date").alias("__d"), *[F.col(c).alias(f"__{c}") for c in zones]).distinct()
    out = df.join(o, F.to_date(ts) == F.col("__d"), "left")
    for c, name in zones.items():
        out = out.withColumn(name, add_hours(F.col(ts), F.col(f"__{c}")))
    return out.drop("__d", *[f"__{c}" for c in zones])


# ---- as-of lookups

def status_asof(keys: DataFrame, changes: DataFrame, offsets: DataFrame, email: str = "email", day: str = "day") -> DataFrame:
    """Last subscribe status of each (e-mail, day) strictly before the local day; null when none.

    ``changes`` holds the contact columns; the time is the unsubscribe time of an
    unsubscribed row and the subscribe time otherwise. At equal times the larger status
    text wins, so that the answer is defined.
    """
    status = F.col("channels_email_subscribeStatus")
    raw = changes.select(F.lower("channels_email_address").alias("__e"), status.alias("subscribeStatus"),
                         as_datetime(F.when(status == "unsubscribed", F.col("channels_email_unsubinfo_ts"))
                                     .otherwise(F.col("channels_email_subinfo_ts"))).alias("ts"))
    facts = with_offset(raw, "ts", offsets, {"UTC_2_PST": "__since"}).where("__since is not null")
    probes = keys.withColumn("__e", F.lower(email)).withColumn("__day_start", F.col(day).cast("timestamp_ntz"))
    out = last_before(probes, facts, ["__e"], "__day_start", "__since", ["subscribeStatus"], ["subscribeStatus"])
    return out.drop("__e", "__day_start").distinct()


def bounded(value: Column, bounds: Sequence[tuple[float, str]], beyond: str) -> Column:
    """Label of the first upper bound that holds the value."""
    out = None
    for limit, text in bounds:
        out = F.when(value <= limit, text) if out is None else out.when(value <= limit, text)
    return F.when(value.isNotNull(), F.lit(beyond) if out is None else out.otherwise(beyond))


def segment_asof(keys: DataFrame, items: DataFrame, buckets: Mapping, email: str = "email", day: str = "day") -> DataFrame:
    """Customer segment of each (e-mail, day): orders so far, days since the last one, what it held.

    Only orders before the day count; a customer without any gets ``Unknown`` everywhere.
    ``buckets`` gives ``orders`` and ``days`` as (bounds, label beyond) and ``premium`` brands.
    """
    contacts = F.col("EyewearType") == "Contact Lenses"
    orders = items.groupBy(F.lower("customer_email").alias("__e"), F.col("Creation_Datetime").alias("__since"),
                           F.col("Order_Number").cast("string").alias("__order")).agg(
        F.max(contacts).alias("c"), F.max(~contacts).alias("g"), F.max("LensType").alias("lensType"),
        F.max(F.col("brand").isin(list(buckets["premium"]))).alias("p"))
    wanted = keys.select(F.lower(email).alias("__e"), F.col(day).alias("__day")).distinct()
    wanted = wanted.where("__e is not null and __day is not null").withColumn("__at", F.col("__day").cast("timestamp_ntz"))
    # customers nobody asks for leave first; orders and their running counts are read twice each
    orders = stage(orders.where("__e <> ''").join(wanted.select("__e").distinct(), "__e", "left_semi"))
    counted = stage(running(orders, ["__e"], F.to_date("__since"), [F.col("__since"), F.col("__order")],
                            {"n": ("sum", F.lit(1))}))
    found = last_before(wanted, counted.withColumn("__last", F.col("__since")), ["__e"], "__at", "__since", ["n"],
                        ["n", "__last", "c", "g", "lensType", "p"])
    since = F.datediff("__day", "__last")
    labels = found.select(
        F.col("__e"), F.col("__day"), bounded(F.col("n"), *buckets["orders"]).alias("noOfOrders"),
        bounded(since, *buckets["days"]).alias("daySinceLastOrder"),
        F.when(F.col("c") & F.col("g"), "Both").when(F.col("c"), "Contacts").when(F.col("g"), "Glasses").alias("productType"),
        F.col("lensType"), F.when(F.col("p"), "Premium").when(~F.col("p"), "Home").alias("brandType"))
    out = keys.join(labels, (F.lower(F.col(email)) == F.col("__e")) & (F.col(day) == F.col("__day")), "left").drop("__e", "__day")
    return out.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in SEGMENTS})


Segmenter = Callable[[DataFrame, str, str], DataFrame]


def segmented(df: DataFrame, segmenter: Segmenter | None, email: str, day: Column) -> DataFrame:
    """Attach the five segment columns, or ``Unknown`` without a segmenter."""
    if segmenter is None:
        return df.withColumns({c: F.lit("Unknown") for c in SEGMENTS})
    return segmenter(df.withColumn("__seg_day", day), email, "__seg_day").drop("__seg_day")


# ---- current platform

def hourly_activity(activity: DataFrame, sent: DataFrame, offsets: DataFrame, since: date | None = None) -> DataFrame:
    """Events per hour and type with the hour in UTC and three zones; sent messages are one more type."""
    both = activity.select(as_datetime("time").alias("ts"), F.col("action").alias("Type")).unionByName(
        sent.select(as_datetime("time").alias("ts"), F.lit("Message_Sent").alias("Type")))
    if since:
        both = both.where(F.to_date("ts") > F.lit(since))
    counts = both.groupBy(trunc_hour("ts").alias("DateTime"), "Type").agg(F.count(F.lit(1)).alias("Amount"))
    zones = {"UTC_2_PST": "Datetime_PST", "UTC_2_EST": "Datetime_EST", "UTC_2_ILS": "Datetime_ILS"}
    return with_offset(counts, "DateTime", offsets, zones).select(
        "DateTime", "Type", "Datetime_PST", "Datetime_EST", "Datetime_ILS", "Amount")


def recommendation_list(df: DataFrame) -> DataFrame:
    """``[a,b]`` to ``["a","b"]`` with a trimmed address; empty lists are dropped."""
    text = F.col("RecProducts")
    for old, new in (("[", '["'), ("]", '"]'), (",", '","')):
        text = F.replace(text, F.lit(old), F.lit(new))
    return df.where(F.col("RecProducts") != "[]").select("id", F.trim("subscriber_email").alias("email"), text.alias("recs"))


def sent_messages(sent: DataFrame, offsets: DataFrame, since: date | None = None, segmenter: Segmenter | None = None) -> DataFrame:
    """Distinct sent messages in UTC and local time from a local day on, with tags and segments."""
    timed = with_offset(sent.where("email is not null").withColumn("Sent_datetime_UTC", as_datetime("time"))
                        .where("Sent_datetime_UTC is not null"), "Sent_datetime_UTC", offsets, {"UTC_2_PST": "Sent_Datetime_PST"})
    if since:
        timed = timed.where(F.to_date("Sent_Datetime_PST") >= F.lit(since))
    rows = timed.select("Sent_datetime_UTC", "Sent_Datetime_PST", "email", "action", "message_name", "mdtID", "msID",
                        "experiment", "variant", "mTags").distinct()
    return segmented(rows, segmenter, "email", F.to_date("Sent_Datetime_PST")).withColumn(
        "mTags", F.coalesce("mTags", F.lit(NO_TAGS)))


def message_fact(activity: DataFrame, sent: DataFrame, offsets: DataFrame, action: str, since: date | None = None,
                 as_of: date | None = None) -> DataFrame:
    """Opens, clicks, opt-outs or bounces joined to the message that was sent.

    Days from ``since`` up to, not including, ``as_of`` by local time. Segments and tags come
    from the sent message, for opt-outs and bounces as well.
    """
    acts = activity.where((F.col("action") == action) & F.col("email").isNotNull())
    acts = with_offset(acts.withColumn("event_datetime_UTC", as_datetime("time")), "event_datetime_UTC", offsets,
                       {"UTC_2_PST": "event_Datetime_PST"})
    local = F.to_date("event_Datetime_PST")
    if since:
        acts = acts.where(local >= F.lit(since))
    if as_of:
        acts = acts.where(local < F.lit(as_of))
    # only clicks know their link, and bounces no device
    carried = {"linkUrl": "link", "linkname": "data_crdl_key", "Device": "Device_type", "Device_OS": "Device_platform"}
    known = {"click": list(carried), "bounce": []}.get(action, ["Device", "Device_OS"])
    acts = acts.select("event_datetime_UTC", "event_Datetime_PST", "email", "message_name", "msID",
                       *[(F.col(c) if n in known else F.lit(None).cast("string")).alias(n) for n, c in carried.items()]).distinct()
    mail = sent.where("Sent_Datetime_PST is not null").select(
        F.col("Sent_datetime_UTC").alias("Sent_Datetime_UTC"), "Sent_Datetime_PST", "email", "message_name", "msID",
        *SEGMENTS, F.coalesce("mTags", F.lit(NO_TAGS)).alias("mTags")).distinct()
    return acts.join(mail, ["email", "message_name", "msID"]).withColumn("kind", F.lit(action))


def newsletter_orders(orders: DataFrame, last_media: DataFrame) -> DataFrame:
    """One row per order: revenue, contact-lens revenue, coupon and whether a newsletter was the last click."""
    grouped = orders.groupBy("customer_email", F.col("Order_Number").cast("string").alias("Order_id"),
                             F.to_date("Creation_Datetime").alias("Date"),
                             F.col("Creation_Datetime").cast("timestamp_ntz").alias("Date_Time"),
                             F.coalesce("Order_Coupon", F.lit("No Coupon")).alias("Coupon")).agg(
        F.sum("ItemRevenue").alias("Revenue"),
        F.sum(F.when(F.col("EyewearType") == "Contact Lenses", F.col("ItemRevenue")).otherwise(0.0)).alias("Revenue_Contacts"))
    news = last_media.where(F.lower("media").contains("newsletter")).select("Order_id", F.lit(True).alias("__news")).distinct()
    return grouped.join(news, "Order_id", "left").withColumn(
        "Order_Att", F.when(F.col("__news"), "Last Click").otherwise("Assisted")).drop("__news")


def click_to_order(clicks: DataFrame, orders: DataFrame, last_media: DataFrame, minutes: int = 480) -> DataFrame:
    """Orders credited to the earliest click (by delivery, then click time) of the same address.

    The click lies at or before the order and at most ``minutes`` minute boundaries away.
    Clicks that tie on both times all stay. Other columns of ``clicks`` are carried along.
    """
    own = clicks.distinct().withColumnsRenamed({"email": "EmailAddress", "Sent_Datetime_PST": "DeliveryDate",
                                                "click_Datetime_PST": "ActionDateTime", "message_name": "MessageName"})
    own = own.where("EmailAddress is not null").drop("Device", "Device_OS")
    bought = newsletter_orders(orders, last_media)
    return _credit(own, bought, minutes, ["EmailAddress"], ["DeliveryDate", "ActionDateTime"])


def _credit(clicks: DataFrame, bought: DataFrame, minutes: int, keys: list[str], order: list[str]) -> DataFrame:
    # addresses that differ in case stay separate customers of the ranking
    spelled = clicks.select("EmailAddress").distinct()
    probes = bought.join(spelled, F.lower("customer_email") == F.lower("EmailAddress")).drop("customer_email")
    if "Date" in keys:
        clicks = clicks.withColumn("Date", F.to_date("ActionDateTime"))
    pick = F.struct(*order)
    best = earliest_within(probes, clicks, keys, "Date_Time", "ActionDateTime", minutes, pick, "__best")
    for c in order:
        best = best.withColumn(c, F.col("__best")[c])
    return best.drop("__best").join(clicks.drop("Date"), ["EmailAddress", *order]).withColumn("Rank", F.lit(1))


def click_to_order_same_day(clicks: DataFrame, orders: DataFrame, last_media: DataFrame, minutes: int = 480,
                            shift_hours: int = 3) -> DataFrame:
    """Older credit rule: one click per link group, clicks moved back ``shift_hours``, same calendar day.

    Of clicks of one address, message, delivery and time the smallest link stays. Messages
    named ``PPS`` are grouped by the unshifted time.
    """
    shifted = F.col("ActionDateTime") - F.expr(f"interval {shift_hours} hours")
    group = F.when(F.col("MessageName").contains("PPS"), F.col("ActionDateTime")).otherwise(shifted)
    keyed = clicks.withColumn("__g", group).withColumn("ActionDateTime", shifted)
    top = keyed.groupBy("EmailAddress", "MessageName", "DeliveryDate", "__g").agg(F.min(F.struct(F.col("linkUrl").isNotNull().alias("n"), "linkUrl")).alias("__l"))
    top = top.select(F.col("EmailAddress").alias("e"), F.col("MessageName").alias("m"), F.col("DeliveryDate").alias("d"),
                     F.col("__g").alias("g"), F.col("__l")["linkUrl"].alias("l"))
    cond = (F.col("EmailAddress").eqNullSafe(F.col("e")) & F.col("MessageName").eqNullSafe(F.col("m"))
            & F.col("DeliveryDate").eqNullSafe(F.col("d")) & F.col("__g").eqNullSafe(F.col("g"))
            & F.col("linkUrl").eqNullSafe(F.col("l")))
    own = keyed.join(top, cond, "left_semi").drop("__g").distinct()
    return _credit(own, newsletter_orders(orders, last_media), minutes, ["EmailAddress", "Date"], ["ActionDateTime"])


FUNNEL_KEYS = ["DeliveryDate", "MessageName", "mTags", *SEGMENTS]


def _funnel_rows(facts: Mapping[str, DataFrame], day: str) -> DataFrame:
    """All facts in one shape; ``day`` is the key date (delivery or action)."""
    keys = [F.coalesce("mTags", F.lit(NO_TAGS)).alias("mTags"), *[F.col(c) for c in SEGMENTS]]
    out = None
    for kind, df in facts.items():
        if kind == "order":
            delivery, acted, name = F.to_date("DeliveryDate"), F.to_date("ActionDateTime"), F.col("MessageName")
            money = [F.col("Revenue").alias("amount"), F.col("Revenue_Contacts").alias("contacts"), F.col("EmailAddress").alias("email")]
        else:
            delivery, name = F.to_date("Sent_Datetime_PST"), F.col("message_name")
            acted = delivery if kind == "sent" else F.to_date("event_Datetime_PST")
            money = [F.lit(None).cast("double").alias("amount"), F.lit(None).cast("double").alias("contacts"), F.col("email")]
        rows = df.select((delivery if day == "delivery" else acted).alias("Day"), name.alias("MessageName"), *keys, F.lit(kind).alias("kind"),
                         acted.alias("acted"), (delivery == acted).alias("d0"), *money)
        out = rows if out is None else out.unionByName(rows)
    return out


def _totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, unique addresses and same-day counts of every kind in two exchanges."""
    zero = F.lit(0)
    per = rows.groupBy(*keys, "kind", "email").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("d0"), 1).otherwise(zero)).alias("n0"),
        F.sum("amount").alias("amount"), F.sum(F.when(F.col("d0"), F.col("amount")).otherwise(0.0)).alias("amount0"),
        F.sum("contacts").alias("contacts"), F.sum(F.when(F.col("d0"), F.col("contacts")).otherwise(0.0)).alias("contacts0"))

    def of(kind: str, c: Column | str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col(c) if isinstance(c, str) else c))

    known = F.col("email").isNotNull().cast("long")
    same = (F.col("email").isNotNull() & (F.col("n0") > 0)).cast("long")
    return per.groupBy(*keys).agg(
        of("sent", "n").alias("Sent"), of("open", "n").alias("open"), of("open", known).alias("Unique_open"),
        of("open", "n0").alias("Open_D0"), of("open", same).alias("Unique_open_D0"),
        of("click", "n").alias("clicks"), of("click", known).alias("Unique_clicks"), of("click", "n0").alias("clicks_D0"),
        of("click", same).alias("Unique_click_D0"), of("order", "n").alias("orders"), of("order", "amount").alias("revenue"),
        of("order", "n0").alias("Orders_D0"), of("order", "amount0").alias("revenue_D0"),
        of("order", "contacts").alias("Contacts_Revenue"), of("order", "contacts0").alias("Contacts_Revenue_D0"),
        of("optout", "n").alias("unsub"), of("bounce", "n").alias("bounce"))


def message_funnel(facts: Mapping[str, DataFrame], since: date | None = None) -> DataFrame:
    """Per delivery date, message and segment: sent, opens, clicks, orders, opt-outs, bounces.

    Only messages touched since a day are recomputed. All facts are stacked and aggregated
    once; rows without sent messages are dropped, as a left join onto sent would do.
    ``facts`` maps sent, open, click, order, optout and bounce to their tables.
    """
    rows = _funnel_rows(facts, "delivery")
    if since:
        # staged, else the optimizer copies the list of touched messages into each kind of fact
        rows = stage(rows)
        touched = stage(rows.where((F.col("acted") >= F.lit(since)) & (F.col("kind") != "order")).select("MessageName", "Day").distinct())
        rows = rows.join(touched, ["MessageName", "Day"], "left_semi")
    out = _totals(rows.where("Day is not null and MessageName is not null"), ["Day", "MessageName", "mTags", *SEGMENTS])
    hard = F.when(F.col("bounce").isNotNull(), F.lit(0))
    return (out.where("Sent is not null").withColumnRenamed("Day", "DeliveryDate")
            .withColumn("hard_bounce", hard).withColumn("soft_bounce", hard))


def message_funnel_action(facts: Mapping[str, DataFrame], since: date | None = None) -> DataFrame:
    """Per action date, message and segment: opens, clicks, orders and opt-outs.

    The spine is every combination with any action; orders are summed over attribution.
    """
    rows = _funnel_rows({k: v for k, v in facts.items() if k != "sent"}, "action").where("MessageName is not null and Day is not null")
    if since:
        rows = rows.where(F.col("Day") >= F.lit(since))
    return _totals(rows, ["Day", "MessageName", "mTags", *SEGMENTS]).select(
        F.col("Day").alias("ActionDate"), "MessageName", "mTags", *SEGMENTS, "open", "Unique_open", "clicks", "Unique_clicks",
        "orders", "revenue", "unsub", "Contacts_Revenue")


def report_snapshot(view: DataFrame, column: str, as_of: date) -> DataFrame:
    """Content of a joined report before today."""
    return view.where(F.col(column) < F.lit(as_of))


# ---- tests

def ab_test_clicks(clicks: DataFrame, credited: DataFrame, final_names: DataFrame, attributes: DataFrame, groups: DataFrame,
                   excluded: DataFrame, since: date) -> DataFrame:
    """Clicks of messages in named tests with order and message attributes; addresses pseudonymised.

    ``final_names`` maps message_name to Final_message_name, ``attributes`` is keyed by
    Bulk_Message_name, ``groups`` lists (TestName, Ver), ``excluded`` one column of names.
    """
    base = clicks.where(F.col("Sent_Datetime_PST") >= F.lit(since).cast("timestamp_ntz"))
    base = not_in(base, F.lower("message_name"), excluded.select(F.lower(excluded.columns[0]).alias("x")))
    orders = credited.select(F.col("DeliveryDate").alias("o_d"), F.col("ActionDateTime").alias("o_a"),
                             F.col("EmailAddress").alias("o_e"), F.col("MessageName").alias("o_m"),
                             F.col("linkUrl").alias("o_l"), "Order_id").distinct()
    joined = base.join(orders, (F.col("Sent_Datetime_PST") == F.col("o_d")) & (F.col("click_Datetime_PST") == F.col("o_a"))
                       & (F.col("email") == F.col("o_e")) & (F.col("message_name") == F.col("o_m"))
                       & F.col("linkUrl").eqNullSafe(F.col("o_l")), "left").drop("o_d", "o_a", "o_e", "o_m", "o_l")
    names = final_names.select(F.lower("message_name").alias("f_n"), "Final_message_name").distinct()
    tests = groups.select("TestName", F.trim(F.lower("Ver")).alias("f_v")).distinct()
    out = (joined.join(names, F.lower("message_name") == F.col("f_n"))
           .join(attributes.withColumnRenamed("Bulk_Message_name", "f_b"), F.col("Final_message_name") == F.col("f_b"))
           .join(tests, F.trim(F.lower("AB_Test_Version")) == F.col("f_v")))
    return (out.withColumn("EmailAddress", pseudonym("email")).withColumn("AB_Test_Version", F.trim("AB_Test_Version"))
            .drop("email", "f_n", "f_v").withColumnRenamed("f_b", "Bulk_Message_name").distinct())


def ab_test_sent(sent: DataFrame, test_clicks: DataFrame) -> DataFrame:
    """Messages sent per day and name, for messages with test clicks."""
    kept = semi_in(sent, F.lower("message_name"), test_clicks.select(F.lower("message_name").alias("m")))
    return kept.groupBy(F.to_date("Sent_Datetime_PST").alias("Sent_Date"), "message_name").agg(F.count(F.lit(1)).alias("Sent"))


def ab_test_orders(items: DataFrame, test_clicks: DataFrame) -> DataFrame:
    """Items of orders credited to test clicks; addresses pseudonymised."""
    kept = semi_in(items, F.col("Order_Number").cast("string"), test_clicks.select("Order_id"))
    return kept.withColumn("EmailAddress", pseudonym("customer_email")).drop("customer_email")


# ---- older platform

def delivery_date(names: DataFrame) -> DataFrame:
    """Delivery date at the head of a message name (``d.m.yy`` or ``d.m.yyyy``).

    Names that start with another character, are empty or hold ``test`` are dropped; a head
    that is no date gives null, and so does a year of any other number of digits.
    """
    parts = split_literal("MessageName", ".")
    day, month = item(parts, 0).try_cast("int"), item(parts, 1).try_cast("int")
    digits = F.regexp_extract(item(parts, 2), r"^\d+", 0)
    year = F.when(F.length(digits) == 4, digits.try_cast("int")).when(F.length(digits) == 2, digits.try_cast("int") + 2000)
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    usable = names.where(F.col("MessageName").isNotNull() & (F.col("MessageName") != "") & ~F.col("MessageName").contains("test")
                         & F.trim("MessageName").rlike("^[0-9.]")).select("MessageName").distinct()
    complete = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return usable.select("MessageName", F.when(complete, F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")).alias("DDate"))


def _start_date(c: str) -> Column:
    return F.when(F.col(c) == "", F.lit(None).cast("date")).otherwise(item(split_literal(c, "T"), 0).try_cast("date"))


def sent_by_segment(outbound: DataFrame, target: DataFrame | None = None, segmenter: Segmenter | None = None) -> DataFrame:
    """Sent count by date, message, type and segment, beyond the target's last date.

    The date is the later of activity date and delivery start; test deliveries are left out.
    """
    rows = outbound.withColumn("Date", F.col("date").cast("date")).withColumn("Create_Date", _start_date("deliveryStart"))
    if target is not None:
        rows = newer_than(rows, "Date", target, "date")
    rows = segmented(rows.where(F.lower("deliveryType") != "test"), segmenter, "emailAddress", F.col("Create_Date"))
    later = F.when(F.col("Date") > F.col("Create_Date"), F.col("Date")).otherwise(F.col("Create_Date"))
    return rows.groupBy(later.alias("date"), "messageName", "deliveryType", *SEGMENTS).agg(F.count(F.lit(1)).alias("Sent"))


def legacy_fact(inbound: DataFrame, dates: DataFrame, kind: str, target: DataFrame | None = None,
                reasons: DataFrame | None = None, segmenter: Segmenter | None = None) -> DataFrame:
    """Opens, clicks, unsubscribes or bounces of the older platform, beyond the target's last action.

    Delivery date comes from the message name, else from the delivery start. Clicks carry a
    time of day and their link, bounces the mapped reason; opens and clicks are distinct.
    """
    same = F.lower("activityType") == kind if kind in ("open", "click") else F.col("activityType") == kind
    rows = inbound.where(same & F.col("messageName").isNotNull())
    names = dates.select(F.col("MessageName").alias("__n"), "DDate").distinct()
    rows = rows.join(names, F.col("messageName") == F.col("__n"), "left")
    rows = rows.withColumn("DeliveryDate", F.coalesce("DDate", _start_date("deliveryStart")))
    acted = "ActionDate"
    if kind == "click":
        acted = "ActionDateTime"
        rows = rows.withColumn(acted, F.concat_ws(" ", "date", F.substring("createdTime", 1, 8)).try_cast("timestamp_ntz"))
    else:
        rows = rows.withColumn(acted, F.col("date").cast("date"))
    if target is not None:
        rows = newer_than(rows, acted, target)
    cols = ["DeliveryDate", acted, F.col("emailAddress").alias("EmailAddress"), F.col("messageName").alias("MessageName")]
    if kind == "click":
        cols += ["linkUrl", F.col("linkName").alias("linkname")]
    if kind == "bounce":
        rows = rows.join(reasons.select("bounceReason", "BounceReason_Name").distinct(), "bounceReason", "left")
        cols += [F.col("BounceReason_Name").alias("BounceReason")]
    rows = rows.select(*cols)
    if kind in ("open", "click"):
        rows = rows.distinct()
    return segmented(rows, segmenter, "EmailAddress", F.col("DeliveryDate"))
