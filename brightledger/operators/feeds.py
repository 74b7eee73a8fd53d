"""Review feed, product feed and order revenue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.columns import item, iso_with_offset, split_literal, to_zone
from ..sources.targets import stage
from .ordered import sweep
from .web import LA


def order_revenue(items: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Revenue per order and day, without and with the gift amount; a null gift drops its line from the second sum."""
    rows = items.where(F.col("Creation_Datetime").between(*[F.lit(t.isoformat(" ")).cast("timestamp_ntz") for t in (start, end)]))
    return rows.groupBy("Order_Number", "Order_SubTotal", F.to_date("Creation_Datetime").alias("Date")).agg(
        F.sum("ItemRevenue").alias("Revenue"), F.sum(F.col("ItemRevenue") + F.col("Item_Gift_Certificate_Amount")).alias("Revenue_with_GC"))


# ---- reviews

def _year(ts: Column, sign: int) -> Column:
    return ts + F.expr(f"interval '{sign}' year")


def purchases_around(reviews: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """Each review with ``earlier`` and ``later``, the orders beside it whose span holds its time, and ``same``, the number of orders at that time.

    ``reviews`` has review_id, the keys and ``at``; ``orders`` the keys, ``ts`` and Order_Number. An order's span goes from the previous to the
    next purchase of the same key; a missing neighbour counts as one year away. Spans that can hold a moment are those of the
    last order before it, of orders at it and of the first order after it. The former reaches the moment if any order
    follows, the latter if any order precedes, so one sweep replaces the range join.
    """
    found = sweep(reviews.select("review_id", *keys, "at"), orders.select(*keys, "ts", "Order_Number"), keys, "at", "ts", ["Order_Number"])
    at, some = F.col("at").cast("timestamp_ntz"), F.col("same") > 0
    earlier = F.when(F.col("after").isNotNull() | some | (_year(F.col("before.ts"), 1) >= at), F.col("before.Order_Number"))
    later = F.when(F.col("before").isNotNull() | some | (_year(F.col("after.ts"), -1) <= at), F.col("after.Order_Number"))
    return found.select("review_id", "at", *keys, earlier.alias("earlier"), later.alias("later"), "same")


def _at_moment(found: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """(review_id, at, keys, Order_Number) of the orders at a review's own moment, for the few reviews that have some."""
    moment = found.where("same > 0").select("review_id", "at", *keys, F.col("at").cast("timestamp_ntz").alias("ts"))
    return moment.join(orders.select(*keys, F.col("ts").cast("timestamp_ntz").alias("ts"), "Order_Number"), [*keys, "ts"]).drop("ts")


def order_rows(found: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """(review_id, at, Order_Number) of ``purchases_around``; orders at a review's own moment are joined."""
    beside = found.select("review_id", "at", F.explode(F.array("earlier", "later")).alias("Order_Number")).where("Order_Number IS NOT NULL")
    return beside.unionByName(_at_moment(found, orders, keys).select("review_id", "at", "Order_Number"))


def at_once(found: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """``purchases_around`` with ``at_once``, the orders at a review's own moment, in place of their number."""
    review, found = ["review_id", "at", *keys], stage(found)
    if not found.where("same > 0").take(1):
        return found.drop("same").withColumn("at_once", F.lit(None).cast(ArrayType(StructType([orders.schema["Order_Number"]]))))
    held = _at_moment(found, orders, keys).distinct()
    return found.drop("same").join(held.groupBy(*review).agg(F.collect_list(F.struct("Order_Number")).alias("at_once")), review, "left")


def _beside(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Moments ``t`` of a key, one row each with the array of their ``orders``, gain ``earlier`` and ``later`` by the rule of ``purchases_around``."""
    numbers = F.transform("orders", lambda x: F.struct(x["Order_Number"]))
    some = F.size("orders") > 0
    up, down = [Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("t"), F.col("t").desc())]
    last, first = [F.when(some, F.struct("t", pick(numbers)["Order_Number"].alias("o"))) for pick in (F.array_max, F.array_min)]
    before, after = F.col("__before"), F.col("__after")
    rows = moments.select("*", F.last(last, ignorenulls=True).over(up).alias("__before"), F.last(first, ignorenulls=True).over(down).alias("__after"))
    earlier = F.when(after.isNotNull() | some | (_year(before["t"], 1) >= F.col("t")), before["o"])
    later = F.when(before.isNotNull() | some | (_year(after["t"], -1) <= F.col("t")), after["o"])
    return rows.select(*moments.columns, earlier.alias("earlier"), later.alias("later"))


def _once(rows: Column) -> Column:
    return F.when(F.size(rows) > 1, F.array_distinct(rows)).otherwise(rows)


def _fits(earlier: Column, later: Column, own_moment: Column) -> Column:
    return earlier.isNotNull() | later.isNotNull() | own_moment


def orders_of_customers(asked: DataFrame, bought: DataFrame) -> DataFrame:
    """The orders around each review (review_id, e, sku, at): of its item, else of its customer; reviews without any drop out.

    ``bought`` has one row an order: e, ts, Order_Number and the array of its ``skus``. Both travel once, to their customer ``e``. There, a first pass over the
    customer's moments finds the orders around a review and a second one, over the moments of each item, those of the item. All rows of a customer are in one task.
    """
    rows = bought.select("e", F.col("ts").alias("t"), "Order_Number", "skus").unionByName(asked.select("e", F.col("at").alias("t"), "review_id", "sku"), allowMissingColumns=True)
    order, review = F.when(F.col("skus").isNotNull(), F.struct("Order_Number", "skus")), F.when(F.col("review_id").isNotNull(), F.struct("review_id", "sku"))
    moments = rows.repartition("e").groupBy("e", "t").agg(F.collect_list(order).alias("orders"), _once(F.collect_list(review)).alias("asked"))
    moments = _beside(moments, ["e"])
    no_number = F.lit(None).cast(StructType([bought.schema["Order_Number"]]))
    no_review = F.lit(None).cast(asked.schema["review_id"].dataType)
    items = F.flatten(F.transform("orders", lambda x: F.transform(x["skus"], lambda s: F.struct(s.alias("s"), F.struct(x["Order_Number"]).alias("number"), no_review.alias("review_id")))))
    reviews = F.transform("asked", lambda x: F.struct(x["sku"].alias("s"), no_number.alias("number"), x["review_id"].alias("review_id")))
    others = F.when(F.size("asked") > 0, F.struct("earlier", "later", F.transform("orders", lambda x: F.struct(x["Order_Number"])).alias("at_once")))
    parts = moments.select("e", "t", others.alias("others"), F.explode(F.concat(items, reviews)).alias("part")).select("e", "t", "others", "part.*")
    parts = parts.groupBy("e", "s", "t").agg(F.collect_list("number").alias("orders"), _once(F.collect_list("review_id")).alias("asked"), F.first("others", ignorenulls=True).alias("others"))
    parts = _beside(parts, ["e", "s"]).where(F.size("asked") > 0)
    own = F.struct(F.lit(True).alias("own_item"), F.col("s"), F.col("earlier"), F.col("later"), F.col("orders").alias("at_once"))
    rest = F.struct(F.lit(False).alias("own_item"), F.lit("").alias("s"), *[F.col(f"others.{c}").alias(c) for c in ("earlier", "later", "at_once")])
    best = F.when(_fits(F.col("earlier"), F.col("later"), F.size("orders") > 0), own).when(
        _fits(F.col("others.earlier"), F.col("others.later"), F.size("others.at_once") > 0), rest)
    found = parts.select("e", F.col("t").alias("at"), best.alias("best"), F.explode("asked").alias("review_id")).where("best IS NOT NULL")
    return found.select("review_id", "at", "e", "best.own_item", "best.s", "best.earlier", "best.later", F.when(F.size("best.at_once") > 0, F.col("best.at_once")).alias("at_once"))


def orders_of_frequent(asked: DataFrame, bought: DataFrame) -> DataFrame:
    """``orders_of_customers`` for customers of many rows: each row goes once under its customer and item and once under its customer alone, and the sweep splits them by day."""

    def keyed(df: DataFrame, own: Column, *cols: str) -> DataFrame:
        level = F.explode(F.concat(F.transform(own, lambda x: F.struct(F.lit(True).alias("own_item"), x.alias("s"))), F.array(F.struct(F.lit(False).alias("own_item"), F.lit("").alias("s")))))
        return df.select("e", level.alias("level"), *cols).select("e", "level.own_item", "level.s", *cols).where("s IS NOT NULL")

    keys, orders = ["e", "own_item", "s"], keyed(bought, F.col("skus"), "ts", "Order_Number")
    found = purchases_around(keyed(asked, F.array("sku"), "review_id", "at"), orders, keys)
    found = at_once(found.where(_fits(F.col("earlier"), F.col("later"), F.col("same") > 0)), orders, keys)
    return found.select("review_id", "at", "e", "own_item", "s", "earlier", "later", "at_once")


def orders_around(asked: DataFrame, bought: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``orders_of_customers``, and ``orders_of_frequent`` for customers of over ``most`` rows. Both inputs are staged."""
    rows = asked.select("e", F.lit(1).alias("n"), F.lit(True).alias("asked")).unionByName(bought.select("e", (F.size("skus") + 1).alias("n"), F.lit(False).alias("asked")))

    def crowded(df: DataFrame, key: str) -> DataFrame:
        return stage(df.groupBy(key).agg(F.sum("n").alias("n"), F.max("asked").alias("asked")).where(F.col("n") > most).drop("n"))

    # customers are counted in few groups first: one of many rows has a group of many, and there hardly is another such group
    rows = rows.withColumn("part", F.pmod(F.hash("e"), F.lit(65536)))
    parts = crowded(rows, "part")
    if not parts.take(1):
        return orders_of_customers(asked, bought)
    frequent = crowded(rows.join(parts.select("part"), "part", "left_semi"), "e")
    cold = orders_of_customers(*[df.join(frequent.select("e"), "e", "left_anti") for df in (asked, bought)])
    if not frequent.where("asked").take(1):  # such as orders without an address
        return cold
    return cold.unionByName(orders_of_frequent(*[df.join(frequent.where("asked").select("e"), "e", "left_semi") for df in (asked, bought)]))


def _unkeyed(found: DataFrame, ids: DataFrame, many: int = 200_000) -> DataFrame:
    """``found`` without moment, customer and item where its review_id is in one row of ``ids`` only: just repeated reviews are told apart by them.

    Ids are counted by five bytes of a hash; one that shares it with another counts as repeated. Where over ``many`` are, all rows stay as they are.
    """
    number = F.pmod(F.xxhash64("__id"), F.lit(1 << 40))
    repeated = ids.select(F.col(ids.columns[0]).alias("__id")).select(number.alias("__no")).repartition("__no").groupBy("__no").count()
    repeated = stage(repeated.where("count > 1").select("__no"))
    if repeated.count() > many:
        return found
    marked = found.withColumn("__id", F.col("review_id")).join(repeated, number == F.col("__no"), "left")
    return marked.select(*[F.when(F.col("__no").isNotNull(), F.col(c)).alias(c) if c in ("at", "e", "s") else F.col(c) for c in found.columns])


def review_feed(reviews: DataFrame, authors: DataFrame, inventory: DataFrame, gtins: DataFrame, mpns: DataFrame, stock: DataFrame,
                items: DataFrame, site: str, zone: str = LA) -> DataFrame:
    """Approved reviews with product data, pros and cons, ISO time and the order they belong to.

    The order is one of the same item around the review, else any order of the customer around it. Texts travel once, to their review_id; its product
    and its orders, found from its keys alone, meet them there.
    """
    # all rows of a review meet by one key; reviews without an id, which take no orders, are spread by their product
    approved = reviews.where("status_id = 1").withColumn("rid", F.coalesce("id", F.hash("product_id").cast(reviews.schema["id"].dataType))).withColumn("no_id", F.col("id").isNull())
    products = (inventory.select("product_id", "sku", F.col("name").alias("product_name"), "brand")
                .join(gtins.select("sku", F.col("UPC").alias("gtin")).distinct(), "sku", "left")
                .join(mpns.select(F.col("id").alias("sku"), F.col("MPN").alias("mpn")).distinct(), "sku", "left")
                .join(stock.select("sku", "url_key").distinct(), "sku", "left"))
    known = approved.select("rid", "no_id", "author_id", "product_id", "created_at")
    known = known.join(authors.select(F.col("id").alias("author_id"), F.lower("email").alias("e")), "author_id", "left").drop("author_id")
    known = stage(known.join(products, "product_id", "left"), "zstd")
    bought = items.select(F.lower("customer_email").alias("e"), F.col("FinalShortSKU").alias("sku"), F.col("Creation_Datetime").cast("timestamp_ntz").alias("ts"), "Order_Number")
    bought = bought.where("e IS NOT NULL AND ts IS NOT NULL").groupBy("Order_Number", "e", "ts").agg(F.collect_set("sku").alias("skus"))
    asked = known.where("NOT no_id").select(F.col("rid").alias("review_id"), "e", "sku", to_zone("created_at", zone).alias("at")).where("e IS NOT NULL AND at IS NOT NULL")
    found = _unkeyed(orders_around(asked, stage(bought, "zstd")), known.where("NOT no_id").select("rid")).withColumnRenamed("review_id", "rid").repartition("rid")
    # rows that repeat a review take the orders of the best match at their moment
    found = found.groupBy("rid", "at").agg(F.max(F.struct("own_item", "e", "s", "earlier", "later", "at_once")).alias("best"))
    beside = F.transform(F.array_compact(F.array("best.earlier", "best.later")), lambda x: F.struct(x.alias("Order_Number")))
    held_at_once = F.coalesce("best.at_once", F.array().cast(found.schema["best"].dataType["at_once"].dataType))
    found = found.select("rid", F.col("at").alias("moment"), F.concat(beside, held_at_once)["Order_Number"].alias("orders"))
    style = F.when(F.col("style") == 1, "Chic").when(F.col("style") == 2, "Vintage").when(F.col("style") == 3, "Classic")
    pros = F.concat(F.when(F.col("recommend"), "Would recommend to others").otherwise(""), F.when(F.col("fit") == 2, ",True to size").otherwise(""),
                    F.when(F.col("style").isNotNull(), F.concat(F.lit(","), style, F.lit(" style"))).otherwise(""),
                    F.when(F.col("quality") == 3, ",High Quality").otherwise(""))
    fit = F.when(F.col("fit") == 1, "Loose").otherwise("Tight")
    cons = F.concat(F.when(F.col("fit") != 2, F.concat(F.lit(","), fit, F.lit(" fit"))).otherwise(""),
                    F.when(F.col("quality") == 1, ",Low Quality").otherwise(""))
    url = F.concat(F.lit(site), F.col("url_key"), F.lit(".html"))
    texts = approved.select("title", "nickname", "detail", "no_id", "overall", "recommend", "fit", "style", "quality", "rid", "author_id", "product_id", "created_at")
    data = ["sku", "brand", "gtin", "mpn", "product_name", "url_key"]
    held = known.select("rid", F.col("product_id").alias("p"), *data).repartition("rid").distinct()
    # products are compared by order, as an equality would shuffle both sides by it
    out = texts.join(held.withColumnRenamed("rid", "r"), (F.col("rid") == F.col("r")) & (F.col("product_id") <= F.col("p")) & (F.col("product_id") >= F.col("p")), "left").drop("r")
    moment = F.col("moment").isNull() | (F.col("moment") == to_zone("created_at", zone))
    out = out.join(found.withColumnRenamed("rid", "r"), (F.col("rid") == F.col("r")) & ~F.col("no_id") & moment, "left").withColumn("transaction_id", F.explode_outer("orders"))
    # distinct while rows still hold the key they met by: they stay where they are
    out = out.select(
        "rid", "no_id", F.col("nickname").alias("reviewer_name"), F.col("author_id").alias("reviewer_id"), iso_with_offset("created_at", zone).alias("review_timestamp"),
        "title", F.col("detail").alias("content"), url.alias("review_url"), F.lit(1).alias("min"), F.lit(5).alias("max"), "overall", "sku", "brand", "gtin", "mpn",
        "product_name", url.alias("product_url"), F.lit("false").alias("is_spam"), F.lit("post_fulfillment").alias("collection_method"), "transaction_id",
        F.regexp_replace(pros, "^,", "").alias("pros"), F.regexp_replace(cons, "^,", "").alias("cons")).distinct()
    return out.select(F.when(~F.col("no_id"), F.col("rid")).alias("review_id"), *out.columns[2:])


# ---- products

# Texts of the shopping feed, in the order of the description and of the columns.
INCLUDED = " - Price includes high quality frames, standard prescription lenses, shipping, free case and cloth. "
SHAPED = (" These ", " shaped ", " are great for ", " shaped faces. Look great in your stylish ")
ONLY, SHIPPED = ". Only $", " - includes shipping!"
EYEGLASSES_CATEGORY = "Health & Beauty > Personal Care > Vision Care > Eyeglasses"
SUNGLASSES_CATEGORY = "Apparel & Accessories > Clothing Accessories > Sunglasses"
RX_LABELS = ("Eyeglasses", "Sunglasses (Non-RX)", "Sunglasses (RX-able)")

def _first_part(c: str) -> Column:
    """Text before the separator `` , `` (one blank before the comma is cut as well)."""
    at = F.instr(F.col(c), F.lit(","))
    return F.when(at > 0, F.left(F.col(c), at - 2)).otherwise(F.col(c))


def _swap(c: Column, rename: Mapping[str, str]) -> Column:
    for old, new in rename.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def base_name(name: Column, color: Column, rename: Mapping[str, str]) -> Column:
    """Product name without its colour words, signs and doubled blanks."""
    words = split_literal(F.replace(color, F.lit(" , "), F.lit(" ")), " ")
    bare = F.aggregate(F.reverse(words), F.trim(_swap(name, rename)), lambda acc, w: F.replace(acc, w, F.lit("")))
    bare = F.replace(bare, F.replace(color, F.lit(" , "), F.lit(" ")), F.lit(""))
    for old, new in (("w/", ""), ("/", ""), (",", ""), ("   ", " "), ("  ", " ")):
        bare = F.replace(bare, F.lit(old), F.lit(new))
    return F.trim(bare)


def number_text(c: Column) -> Column:
    """A number rounded to cents as shortest text (``12.5``, ``12.0`` as ``12``)."""
    return F.regexp_replace(F.round(c.cast("double"), 2).cast("string"), r"\.0$", "")


def product_feed(stock: DataFrame, keywords: DataFrame, inventory: DataFrame, prices: DataFrame, gtins: DataFrame, mpns: DataFrame, promos: DataFrame, *,
                 site: str, images: str, home_brand: str, rename: Mapping[str, str], skipped: Sequence[str] = ("lenses", "nico", "snap-", "product"),
                 skipped_prefix: str = "73-") -> DataFrame:
    """Items in stock as shopping feed rows.

    Stock numbers holding any of ``skipped`` are left out. ``promos`` gives promo code and
    discount per brand; brands without one keep their price. Text built from a missing part is null.
    """
    lows = [~F.lower("sku").contains(s) for s in skipped]
    own = stock.where((F.col("qty").cast("long") > 0) & (F.substring("sku", 3, 1) == "-") & ~F.col("sku").startswith(skipped_prefix))
    for cond in lows:
        own = own.where(cond)
    inv = inventory.select(F.lower("sku").alias("i"), "frame_type", F.coalesce("eyewear_type", F.lit("Eyeglasses")).alias("kind"),
                           "eligible_for_rx_lenses", F.col("extlab_id").alias("extlab")).distinct()
    fix = prices.select(F.lower("sku").alias("p"), F.col("Price").alias("p1"), F.col("Final_Price").alias("p2")).distinct()
    low = F.lower("sku")
    rows = (own.join(keywords.select(F.col("Unique_ID").alias("sku"), "Keyword", "SKU_Prefix", "face_shape").distinct(), "sku", "left")
            .join(inv, low == F.col("i"), "left").join(fix, low == F.col("p"), "left")
            .join(gtins.select("sku", F.col("UPC").alias("gtin")).distinct(), "sku", "left")
            .join(mpns.select(F.col("id").alias("sku"), F.col("MPN").alias("mpn")).distinct(), "sku", "left")
            .join(promos.select(F.col("brand").alias("b"), "promo_code", "discount").distinct(), F.col("brand") == F.col("b"), "left"))
    name, color, shape = F.col("name"), F.col("color"), F.col("shape")

    def plain(c: Column) -> Column:
        return F.replace(c, F.lit("Shiny "), F.lit(""))

    second = F.when(F.instr(color, F.lit(",")) > 0, F.trim(item(split_literal(color, ","), 1))).otherwise(color)
    named = (F.instr(name, plain(_first_part("color"))) > 0) | (F.instr(name, plain(second)) > 0)
    keyword = F.trim("Keyword")
    blank = F.lit(" ")
    head = F.when(named, F.concat(name, blank, F.trim(_first_part("shape")), blank, keyword)).otherwise(
        F.concat(name, blank, F.trim(color), blank, F.trim(_first_part("shape")), blank, keyword))
    who = F.when(F.col("gender") == "Men", " for Men.").when(F.col("gender") == "Women", " for Women.").otherwise(".")
    description = F.concat(
        F.trim(_swap(F.replace(head, F.lit(" , "), F.lit("/")), rename)),
        F.lit(INCLUDED), F.col("frame_size"), blank, color, blank,
        F.col("frame_type"), blank, F.col("framematerial"), blank, keyword, who, F.lit(SHAPED[0]), shape, F.lit(SHAPED[1]), keyword, F.lit(SHAPED[2]),
        F.col("face_shape"), F.lit(SHAPED[3]), keyword, F.lit(ONLY), number_text(F.col("final_price")),
        F.when(F.col("SKU_Prefix") == "62-", "").otherwise(SHIPPED))
    path = F.reverse(split_literal("front_image", "/"))

    def filled(c: str) -> Column:
        return F.col(c).isNotNull() & (F.col(c) != "")

    front = F.when(filled("front_image"), F.concat(F.lit(images + "/"), item(path, 2), F.lit("/"), item(path, 1), F.lit("/"), item(path, 0)))
    side, angle = F.concat(F.lit(images), F.col("side_image")), F.concat(F.lit(images), F.col("angle_image"))
    more = F.when(filled("side_image"), F.when(filled("angle_image"), F.concat(side, F.lit(","), angle)).otherwise(side)).when(filled("angle_image"), angle)
    link = F.concat(F.lit(site), F.col("url_key"), F.lit(".html"), F.coalesce(F.concat(F.lit("?promo="), F.col("promo_code")), F.lit("")))
    bare = base_name(name, color, rename)
    size = F.lower("frame_size").isin("pre-teens", "juniors", "toddlers")
    age = F.when(F.col("category_ids").contains("159") | F.lower(bare).contains("kids") | size, "Kids").otherwise("Adult")
    gender = F.lower("gender")
    title = _swap(F.trim(name), rename)
    price, final = F.coalesce("p1", "price"), F.coalesce("p2", "final_price")
    sale = F.when(F.col("promo_code").isNull(), final.cast("double")).otherwise(final.cast("double") * (1 - F.col("discount")))
    rx = F.when(F.lower("kind") == "eyeglasses", RX_LABELS[0]).when(F.col("eligible_for_rx_lenses") != "Yes", RX_LABELS[1]).otherwise(RX_LABELS[2])
    empty = F.lit(None).cast("string")
    return rows.select(
        F.col("sku").alias("id"), F.lit("in stock").alias("availability"), F.col("qty").alias("quantity_to_sell"), F.lit("new").alias("condition"),
        description.alias("description"), front.alias("image_link"), link.alias("link"), title.alias("title"), F.concat(number_text(price), F.lit(" USD")).alias("price"),
        "gtin", "mpn", F.when(filled("brand"), F.col("brand")).otherwise(home_brand).alias("brand"), more.alias("additional_image_link"), age.alias("age_group"),
        F.replace(color, F.lit(" , "), F.lit("/")).alias("color"), F.lit(None).cast("date").alias("expiration_date"),
        F.when(gender.isin("men", "boys"), "Male").when(gender.isin("women", "girls"), "Female").otherwise("Unisex").alias("gender"), title.alias("item_group_id"),
        F.when(F.lower(rx).contains("sunglasses"), SUNGLASSES_CATEGORY)
        .otherwise(EYEGLASSES_CATEGORY).alias("google_product_category"),
        F.col("frame_size").alias("size"), F.col("framematerial").alias("material"), empty.alias("pattern"),
        F.when(filled("product_badge"), F.col("product_badge")).otherwise("Home Brand").alias("product_type"),
        F.concat(number_text(sale), F.lit(" USD")).alias("sale_price"), F.lit(None).cast("date").alias("sale_price_effective_date"),
        F.lit(None).cast("double").alias("shipping"), F.lit("0.50 lb").alias("shipping_weight"), empty.alias("shipping_size"),
        F.when(F.col("product_badge").contains("Special Sale"), "Special Sale").otherwise(F.col("product_badge")).alias("custom_label_0"),
        bare.alias("custom_label_1"), F.col("extlab").alias("custom_label_2"), rx.alias("custom_label_3"))
