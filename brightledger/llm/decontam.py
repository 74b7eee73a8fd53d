"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Numbers, units and names become typed placeholders, so a question with other values keeps its template. Templates are cut
into windows of words; the windows of all documents meet those of the benchmark in a hash join. Neighbouring placeholders
of a kind are folded into one first, so values of other lengths ('Mary Ann', '1 200', '5km') move no window. Hits on one
diagonal (document place minus item place), or on diagonals at most an item's length apart, that cover enough of an item are
candidates; their slots must be filled consistently: equal values in the item stand for equal values in the document and
different ones for different ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage
from .common import few, without

#: Words of a window; items of fewer words use the next size. Items under four words are no evidence and are not searched.
SIZES = (8, 4)
#: Share of an item's usable windows that a document must hold in place.
COVER = 0.4
#: Words of a window, in percent, that must not be placeholders.
LITERAL = 50
UNITS = ("mm|cm|dm|m|km|in|ft|yd|mi|mg|g|kg|t|lb|lbs|oz|ml|cl|l|ms|s|sec|min|h|hr|hrs|hours?|minutes?|seconds?|days?|weeks?|months?|years?|"
         "percent|degrees?|dollars?|euros?|cents?|meters?|metres?|miles?|grams?|liters?|litres?|usd|eur|gbp|kb|mb|gb|tb|hz|khz|mhz|ghz|w|kw|v|a|k")
#: Placeholders are digits: all numbers of the text are replaced first, so no other word is made of digits.
NUMBER, UNIT, NAME = "0", "1", "2"
SLOT = f"^[{NUMBER}{UNIT}{NAME}]+$"
#: Placeholders of which neighbouring words are folded.
FOLDED = (NUMBER + UNIT, NAME)


def stripped(text: Column) -> Column:
    """Words of a text without punctuation; words of nothing else vanish. Null counts as empty."""
    return listed(plain(text))


def plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}\s]+", ""), r"\s+", " "))


def listed(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def canonical(text: Column) -> Column:
    out = F.regexp_replace(text, r"(?<![\p{L}\p{N}_])\d+(?:[.,:/]\d+)*", NUMBER)
    out = F.regexp_replace(out, rf"(?i)(?<=0)( ?)(?:{UNITS})(?![\p{{L}}\p{{N}}])", f"$1{UNIT}")
    out = F.regexp_replace(out, r"(?<=[\p{L}\p{N},;] )\p{Lu}[\p{L}\p{M}'-]*", NAME)
    return plain(F.lower(out))


def template(text: Column) -> Column:
    """Canonical words, place by place those of ``stripped``: a number, a unit after a number, a capitalised word inside a sentence, or the word in lower case."""
    return listed(canonical(text))


def folded(text: Column) -> Column:
    """The template with runs of number and unit words, and runs of names, as one word each: a number, a number with unit, a name."""
    out = canonical(text)
    for kind in FOLDED:
        out = F.regexp_replace(out, rf"(?<![^ ])[{kind}]+ (?=[{kind}]+(?![^ ]))", "")
    out = F.regexp_replace(out, rf"(?<![^ ]){NUMBER}*{UNIT}+(?![^ ])", NUMBER + UNIT)
    return listed(F.regexp_replace(out, rf"(?<![^ ]){NUMBER}+(?![^ ])", NUMBER))


def forms(text: Column, fold: bool) -> Column:
    return folded(text) if fold else template(text)


def filled(df: DataFrame, text_col: str, fold: bool) -> DataFrame:
    """``df`` with ``begins`` and ``values``: for each word of ``forms`` the place of its first own word, and its own words in lower case as one."""
    df = df.withColumn("raw", template(F.col(text_col))).withColumn("own", stripped(F.lower(text_col)))

    def goes_on(i: Column) -> Column:
        here, after = F.get("raw", i), F.coalesce(F.get("raw", i + 1), F.lit(""))
        return F.lit(fold) & F.array_contains(F.array(*(here.rlike(f"^[{k}]+$") & after.rlike(f"^[{k}]+$") for k in FOLDED)), True)

    places = F.when(F.size("raw") > 0, F.sequence(F.lit(0), F.size("raw") - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("ends", F.filter(places, lambda i: ~goes_on(i)))
    df = df.withColumn("begins", F.transform("ends", lambda _, k: F.when(k == 0, 0).otherwise(F.get("ends", k - 1) + 1)))
    return df.withColumn("values", F.zip_with("begins", "ends", lambda a, b: F.array_join(F.slice("own", a + 1, b - a + 1), ""))).drop("raw", "own", "ends")


def with_windows(df: DataFrame, size: int) -> DataFrame:
    """``df`` with ``windows``, hashes of all windows of ``size`` (a power of two) of its ``words``, made by doubling; null for shorter texts.

    Each width is a column of its own, as the next one reads it three times. Explode it as outer: else the optimizer
    filters on the array's size first and makes the windows twice.
    """
    df = df.withColumn("windows", F.transform("words", lambda w: F.xxhash64(w)))
    width = 1
    while width < size:
        n = F.size("windows") - width
        df = df.withColumn("windows", F.when(n > 0, F.zip_with(F.slice("windows", F.lit(1), n), F.slice("windows", F.lit(width + 1), n), lambda a, b: F.xxhash64(a, b))))
        width *= 2
    return df


def item_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Staged (item, size, fold, n, length, place, h) of the usable windows; n counts an item's, length its words. Of items that repeat an id, equal texts count once.

    Items that have four words only as long as nothing is folded are searched without folding.
    """
    texts = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("item", template(F.col("text")).alias("raw"), folded(F.col("text")).alias("words")).distinct()
    parts = []
    for size, above in zip(SIZES, (None, *SIZES)):
        fit = texts.where((F.size("words") >= size) & (F.size("words") < above if above else F.lit(True)))
        parts.append(usable_windows(fit.select("item", "words"), size, True))
    short = texts.where((F.size("words") < SIZES[-1]) & (F.size("raw") >= SIZES[-1]))
    parts.append(usable_windows(short.select("item", F.col("raw").alias("words")), SIZES[-1], False))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    totals = rows.groupBy("item", "size", "fold").agg(F.countDistinct("place", "h").alias("n"), F.max("length").alias("length"))
    return stage(rows.drop("length").distinct().join(totals, ["item", "size", "fold"]))


def usable_windows(items: DataFrame, size: int, fold: bool) -> DataFrame:
    rows = with_windows(items, size).select("item", F.lit(size).alias("size"), F.lit(fold).alias("fold"), "words", F.posexplode_outer("windows").alias("place", "h")).where("h IS NOT NULL")
    usable = F.size(F.filter(F.slice("words", F.col("place") + 1, F.lit(size)), lambda w: ~w.rlike(SLOT))) * 100 >= LITERAL * size
    return rows.where(usable).select("item", "size", "fold", F.size("words").alias("length"), "place", "h")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", cover: float = COVER) -> DataFrame:
    """(``id_col``, ``item_col``, place, share): documents that hold an item, its first word's place and the share of its windows found.

    One row per document and item, with the best place (the earliest of equal ones). Words may be put in, left out or split:
    windows on diagonals up to an item's length apart are added up. Null or empty texts hold nothing; rows
    with a null id are not reported; rows that repeat an id count as one document. Of a benchmark with more windows than fit
    a broadcast the join shuffles instead.
    """
    wanted = item_windows(benchmark, item_col, item_text_col)
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__doc"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    kinds = [(r["size"], r["fold"]) for r in wanted.select("size", "fold").distinct().collect()]  # at most len(SIZES) + 1 rows
    hits = None
    for size, fold in kinds:
        own = few(wanted.where((F.col("size") == size) & (F.col("fold") == fold)).select(F.col("item").alias("__item"), "n", "length", F.col("place").alias("start"), "h"))
        cut = with_windows(named.select("__doc", forms(F.col("__text"), fold).alias("words")), size)
        found = cut.select("__doc", F.posexplode_outer("windows").alias("place", "h")).join(own, "h")
        found = found.select("__doc", "__item", "n", "length", F.lit(size).alias("size"), F.lit(fold).alias("fold"), "start", (F.col("place") - F.col("start")).alias("shift"))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return named.where("false").join(benchmark.select(F.col(item_col).alias("__item")).where("false"), F.lit(True)).select(
            F.col("__doc").alias(id_col), F.col("__item").alias(item_col), F.lit(0).alias("place"), F.lit(0.0).alias("share"))
    key = ["__doc", "__item", "n", "length", "size", "fold"]
    runs = hits.groupBy(*key, "shift").agg(F.collect_set("start").alias("starts"))
    # bands of two lengths of diagonals overlap by one, so diagonals a length apart share a band
    band = F.floor(F.col("shift") / F.col("length"))
    bands = runs.select(*key, F.explode(F.array(band, band + 1)).alias("band"), F.struct("shift", "starts").alias("line")).groupBy(*key, "band").agg(F.collect_list("line").alias("lines"))
    bands = bands.withColumn("all", F.array_distinct(F.flatten("lines.starts")))
    bands = stage(bands.where(F.size("all") >= cover * F.col("n")))
    # each diagonal alone, and with what its neighbours have of the rest: of each window the hit on the nearest diagonal
    lone = F.transform("line.starts", lambda s: F.struct(s.alias("start"), F.col("line.shift").alias("shift")))

    def nearest(s: Column) -> Column:
        held = F.filter("lines", lambda x: F.array_contains(x["starts"], s) & (F.abs(x["shift"] - F.col("line.shift")) <= F.col("length")))
        return F.array_min(F.transform(held, lambda x: F.struct(F.abs(x["shift"] - F.col("line.shift")).alias("off"), x["shift"].alias("shift"))))["shift"]

    near = F.filter(F.transform("all", lambda s: F.struct(s.alias("start"), nearest(s).alias("shift"))), lambda x: x["shift"].isNotNull())
    chains = bands.withColumn("line", F.explode("lines")).select(*key, F.explode(F.array(lone, near)).alias("chain"))
    chains = stage(chains.withColumn("chain", F.array_sort("chain")).where(F.size("chain") >= cover * F.col("n")).distinct())
    # the slots of the matched windows, with the words that fill them on either side
    held = named.join(few(stage(chains.select("__doc").distinct())), "__doc", "left_semi").distinct()
    items = benchmark.select(F.col(item_col).alias("__item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("__text")).distinct()
    best = None
    for fold in sorted({f for _, f in kinds}):
        texts = filled(held, "__text", fold).select("__doc", F.col("begins"), F.col("values").alias("theirs"))
        asked = filled(items, "__text", fold).select("__item", forms(F.col("__text"), fold).alias("words"), "values")
        steps = F.flatten(F.transform("chain", lambda c: F.transform(F.sequence(c["start"], c["start"] + F.col("size") - 1), lambda p: F.struct(p.alias("p"), (p + c["shift"]).alias("q")))))
        slots = F.filter(F.array_distinct(steps), lambda x: F.get("words", x["p"]).rlike(SLOT))
        both = F.transform(slots, lambda x: F.struct(F.get("values", x["p"]).alias("a"), F.get("theirs", x["q"]).alias("b")))
        # a number and its unit are two values
        parted = F.flatten(F.transform(both, lambda x: F.array(*(F.struct(F.regexp_extract(x["a"], r, 0).alias("a"), F.regexp_extract(x["b"], r, 0).alias("b")) for r in ("^[0-9]+", "[^0-9].*$")))))
        pairs = F.array_distinct(F.filter(parted, lambda x: (x["a"] != "") | (x["b"] != "")))
        full = chains.where(F.col("fold") == fold).join(few(asked), "__item").join(texts, "__doc").withColumn("pairs", pairs)
        # equal values of the item must be equal in the document; different ones may happen to become equal
        steady = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["a"])))
        first = F.get("chain", F.lit(0))["shift"]
        place = F.coalesce(F.when(first >= 0, F.get("begins", F.greatest(first, F.lit(0)))), first)
        part = full.where(steady).select("__doc", "__item", (F.size("chain") / F.col("n")).alias("share"), (-place).alias("back"))
        best = part if best is None else best.unionByName(part)
    best = best.groupBy("__doc", "__item").agg(F.max(F.struct("share", "back")).alias("best"))
    return best.select(F.col("__doc").alias(id_col), F.col("__item").alias(item_col), (-F.col("best.back")).cast("int").alias("place"), F.col("best.share").alias("share"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The input rows, all columns as they are, without documents that hold an item. Rows with a null id stay."""
    return without(docs, id_col, leaks(docs, benchmark, id_col, **how).select(id_col))
