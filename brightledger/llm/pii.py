"""Personal data by weak supervision, in DataFrame operations only.

Strict patterns give the base spans. Wider patterns give candidates, on which labelers vote for, against or not at all:
form (regex), gazetteer (lists of endings, prefixes and titles) and context (words around). Votes are counted per pattern of
votes over all documents; expectation-maximisation on these counts estimates each labeler's reliability and each pattern's
probability. With those as soft labels, grouped counts train the final span classifier, a naive Bayes on features the
labelers don't read alone (length, digit share, what stands before and after). Candidates it accepts are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage

#: Order of kinds in listings; the first four are base kinds, "name" is only added.
KINDS = ("email", "ip", "card", "phone", "name")
LOCAL = "A-Za-z0-9._%+-"
#: Each base pattern in a form that takes linear time. A local part is tried only at its first letter (or where the last match
#: ended) and never given back; a card's digits are counted while matching, from the first digit of a row to its last, so
#: rows of any length fail or match at once.
ADDRESS = rf"[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
EMAIL = rf"(?:\G|(?<![{LOCAL}])){ADDRESS}"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

#: Wider patterns of candidates, with bounded repeats.
MAIL_LIKE = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,5}"
NUMBER_LIKE = r"(?<![0-9A-Za-z.+-])[(+]?[0-9](?:[ ().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])"
NAME_LIKE = r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señora?|Monsieur|Madame|Mme)\.? \p{Lu}[\p{L}'-]{1,30}(?: \p{Lu}[\p{L}'-]{1,30})?"
#: What every text with such a number holds.
NUMBER_GATE = r"[0-9](?:[ ().-]{0,2}[0-9]){6}"
FORMS = (("mail", MAIL_LIKE), ("number", NUMBER_LIKE), ("name", NAME_LIKE))
#: Letters of text before and after a candidate that the context labelers read.
BEFORE, AFTER = 40, 15
LABELERS = ("form", "gazetteer", "cue", "counter", "shape")
ENDINGS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|nl|ch|at|us|ca|au|br|jp"
CODES = r"^\+?\(?(?:1|7|20|27|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])(?![0-9]{16})"
CUES = {"mail": "mail|contact|write|schreib|correo|courriel|adress|kontakt", "number": "phone|call|tel|fax|mobil|card|karte|carte|tarjeta|konto|account|ssn|contact|kontakt|number|nummer",
        "name": "name|contact|from|signed|dear|by|von|de|avec"}
COUNTERS = r"isbn|issn|version|v\.|usd|eur|[$€£]|page|seite|chapter|no\.|nr\.|doi|id[:=]"


def found(text: Column, pattern: str, where: Column) -> Column:
    """All matches; an empty array where ``where`` doesn't hold, so that the pattern runs on few texts."""
    return F.when(where, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def placed(df: DataFrame, name: str, pattern: str, where: Column) -> DataFrame:
    """``df`` with ``name``, the matches in its ``text`` as (start, end, value) in code points.

    Matches and the pieces between them come from the same scan order, so running sums of their lengths are the places.
    Each step is a column of its own and computed once.
    """
    df = df.withColumn("__m", found(F.col("text"), pattern, where))
    df = df.withColumn("__p", F.when(F.size("__m") > 0, F.split("text", pattern, -1)))
    both = F.zip_with("__p", "__m", lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("value")))
    both = F.filter(both, lambda x: x["value"].isNotNull())
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    walked = F.aggregate(both, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return df.withColumn(name, F.when(F.size("__m") > 0, walked).otherwise(empty)).drop("__m", "__p")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """The digits' check sum ends in zero."""
    order = F.reverse(F.split(digits(value), ""))
    each = F.transform(order, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(name: str, value: Column) -> Column:
    """What a match of a base pattern must also hold."""
    if name == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.regexp_replace(p, "^0+(?=.)", "").cast("int") <= 255))
    if name == "card":
        return luhn(value)
    if name == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def spans_of(name: str, kind: int) -> Column:
    return F.transform(F.filter(name, lambda s: valid(name, s["value"])), lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def votes(form: str, value: Column, before: Column, after: Column) -> list[Column]:
    """One vote (1, 0 or -1) of each labeler."""
    def vote(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, 1).when(no if no is not None else F.lit(False), -1).otherwise(0)

    if form == "mail":
        by_form = vote(value.rlike(f"^{ADDRESS}$"), ~value.rlike("@"))
        gazetteer = vote(value.rlike(rf"(?i)(?:{ENDINGS})$"), value.rlike(r"(?i)\.(?:png|jpg|js|css|py|java|txt)$"))
        shape = vote(~value.rlike(r"[ ()\[\]]"), value.rlike(r"^.{0,2}@|\d{8,}@"))
    elif form == "number":
        n = F.length(digits(value))
        by_form = vote(value.rlike(r"^\+") & n.between(9, 15) | n.between(12, 19) & luhn(value), (n < 9) & ~value.rlike("[() -]"))
        gazetteer = vote(value.rlike(CODES) & value.rlike(r"^[+(]"), value.rlike(r"^(?:19|20)\d\d[-.]\d\d[-.]\d\d"))
        shape = vote(value.rlike(r"^\+?\(?\d{1,4}\)?(?:[ .-]\(?\d{2,4}\)?){2,5}$"), value.rlike(r"^\d+$") & ~n.between(12, 19))
    else:
        by_form = vote(value.rlike(r"\. \p{Lu}"), value.rlike(r"\p{Lu}{3,}"))
        gazetteer = vote(value.rlike(r"^(?:Mr|Mrs|Ms|Dr|Herr|Frau)"), None)
        shape = vote(value.rlike(r" \p{Lu}\S+ \p{Lu}\S+$"), value.rlike("[0-9]"))
    return [by_form, gazetteer, vote(before.rlike(rf"(?i)(?:{CUES[form]})")), vote(F.lit(False), before.rlike(rf"(?i)(?:{COUNTERS})\s*\S*\s*$")), shape]


def candidates(form: str, name: str, text: Column) -> Column:
    """Array of (form, start, end, votes, features) of the candidates in column ``name``."""
    def one(s: Column) -> Column:
        start = F.greatest(F.lit(0), s["start"] - BEFORE)
        before, after = F.substring(text, start + 1, s["start"] - start), F.substring(text, s["end"] + 1, F.lit(AFTER))
        size, n = s["end"] - s["start"], F.length(digits(s["value"]))
        features = F.array(F.concat(F.lit("size "), F.least(F.lit(12), F.floor(size / 3)).cast("string")), F.concat(F.lit("digits "), F.floor(n * 5 / size).cast("string")),
                           F.concat(F.lit("before "), F.when(before.rlike(r"[:=] ?$"), "mark").when(before.rlike(r"\p{L} $"), "word").when(before.rlike(r"[.!?] ?$|^$"), "start").otherwise("other")),
                           F.concat(F.lit("after "), F.when(after.rlike(r"^ \p{Ll}"), "word").when(after.rlike(r"^[.,;!?]|^$"), "end").otherwise("other")))
        return F.struct(F.lit(form).alias("form"), s["start"].alias("start"), s["end"].alias("end"), F.concat_ws(",", *[v.cast("string") for v in votes(form, s["value"], before, after)]).alias("votes"), features.alias("features"))

    return F.transform(name, one)


def reliabilities(counts: dict[tuple[str, str], int], steps: int = 30) -> dict[tuple[str, str], float]:
    """Probability of each (form, pattern of votes), by expectation-maximisation with one latent class per form.

    Each labeler has, per class, a distribution over its three votes. The start trusts the labelers: the share of votes for.
    The table has at most 3 ** len(LABELERS) patterns per form, whatever the number of documents.
    """
    out: dict[tuple[str, str], float] = {}
    for form in sorted({f for f, _ in counts}):
        rows = [(tuple(map(int, p.split(","))), n, p) for (f, p), n in sorted(counts.items()) if f == form]
        good = [min(0.95, max(0.05, 0.4 + 0.25 * sum(v))) for v, _, _ in rows]
        for _ in range(steps):
            total = sum(n for _, n, _ in rows)
            share = min(0.99, max(0.01, (sum(g * n for g, (_, n, _) in zip(good, rows)) + 1) / (total + 2)))
            logs = []
            for i in range(len(LABELERS)):
                table = {}
                for v in (-1, 0, 1):
                    # a labeler is taken to be better than chance: one pseudo-count for voting right
                    yes = sum(g * n for g, (p, n, _) in zip(good, rows) if p[i] == v) + (2 if v > 0 else 1 if v == 0 else 0.5)
                    no = sum((1 - g) * n for g, (p, n, _) in zip(good, rows) if p[i] == v) + (2 if v < 0 else 1 if v == 0 else 0.5)
                    table[v] = (yes, no)
                sums = [sum(x[j] for x in table.values()) for j in (0, 1)]
                logs.append({v: math.log(a / sums[0]) - math.log(b / sums[1]) for v, (a, b) in table.items()})
            odds = [math.log(share / (1 - share)) + sum(logs[i][x] for i, x in enumerate(v)) for v, _, _ in rows]
            good = [1 / (1 + math.exp(-max(-30.0, min(30.0, o)))) for o in odds]
        out |= {(form, p): g for g, (_, _, p) in zip(good, rows)}
    return out


def classifier(rows: DataFrame, soft: dict[tuple[str, str], float]) -> tuple[dict[str, float], dict[tuple[str, str], float]]:
    """(log-odds of each form, weight of each (form, feature)) from grouped soft counts; both tables are bounded by the features' bins."""
    lookup = F.create_map(*[x for (f, p), g in soft.items() for x in (F.lit(f"{f}|{p}"), F.lit(float(g)))])
    scored = rows.groupBy("c.form", "c.votes", "c.features").count().withColumn("good", F.element_at(lookup, F.concat_ws("|", "form", "votes")))
    table = scored.select("form", F.explode(F.concat(F.col("features"), F.array(F.lit("")))).alias("feature"), "count", "good")
    sums = {(r["form"], r["feature"]): (r["yes"], r["no"]) for r in table.groupBy("form", "feature").agg(F.sum(F.col("count") * F.col("good")).alias("yes"), F.sum(F.col("count") * (1 - F.col("good"))).alias("no")).collect()}
    prior = {f: math.log((yes + 1) / (no + 1)) for (f, feature), (yes, no) in sums.items() if not feature}
    weights = {}
    for (f, feature), (yes, no) in sums.items():
        if feature:
            all_yes, all_no = sums[f, ""]
            weights[f, feature] = math.log((yes + 1) / (all_yes + 2)) - math.log((no + 1) / (all_no + 2))
    return prior, weights


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """(``id_col``, base, spans), one row per input row: arrays of (start, kind, end) in code points, end exclusive, by start and kind.

    ``kind`` is the place in KINDS; ``spans`` holds ``base`` and the accepted candidates that overlap no base span. Null or
    empty texts have no spans; ids may be null or repeat; other columns are not read. The text is read once; what is found
    is staged.
    """
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    at, digit = F.col("text").contains("@"), F.col("text").rlike(NUMBER_GATE)
    dotted, many = F.col("text").rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), F.col("text").rlike("[0-9](?:[ -]?[0-9]){11}")
    df = df.withColumns({"at": at | F.col("text").rlike(r"\((?:at)\)|\[at\]"), "digit": digit, "dotted": dotted, "many": many, "plus": F.col("text").contains("+"), "title": F.col("text").rlike(NAME_LIKE)})
    for name, pattern, where in (("email", EMAIL, F.col("at")), ("ip", IP, F.col("dotted")), ("card", CARD, F.col("many")), ("phone", PHONE, F.col("plus"))):
        df = placed(df, name, pattern, where)
    for (form, pattern), where in zip(FORMS, ("at", "digit", "title")):
        df = placed(df, form, pattern, F.col(where))
    base = F.array_sort(F.concat(*[spans_of(k, i) for i, k in enumerate(KINDS[:4])]))
    loose = F.concat(*[candidates(form, form, F.col("text")) for form, _ in FORMS])
    df = df.withColumn("base", base)
    free = F.filter(loose, lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    held = stage(df.select("id", "base", loose.alias("loose"), free.alias("free")))

    rows = held.select(F.explode_outer("loose").alias("c")).where("c IS NOT NULL")
    counts = {(r["form"], r["votes"]): r["count"] for r in rows.groupBy("c.form", "c.votes").count().collect()}
    if not counts:
        return held.select(F.col("id").alias(id_col), "base", F.col("base").alias("spans"))
    prior, weights = classifier(rows, soft := reliabilities(counts))
    table = F.create_map(*[x for (f, v), w in weights.items() for x in (F.lit(f"{f}|{v}"), F.lit(float(w)))])
    start = F.create_map(*[x for f, w in prior.items() for x in (F.lit(f), F.lit(float(w)))])
    label = F.create_map(*[x for (f, p), g in soft.items() for x in (F.lit(f"{f}|{p}"), F.lit(math.log(max(1e-9, g) / max(1e-9, 1 - g))))])

    def score(c: Column) -> Column:
        """Labelers' log-odds on top of the classifier's, whose own prior they already hold."""
        own = F.aggregate(c["features"], F.lit(0.0), lambda s, f: s + F.coalesce(F.element_at(table, F.concat(c["form"], F.lit("|"), f)), F.lit(0.0)))
        return (F.element_at(start, c["form"]) + own + F.element_at(label, F.concat(c["form"], F.lit("|"), c["votes"]))) / 2

    kind = F.create_map(F.lit("mail"), F.lit(0), F.lit("number"), F.lit(3), F.lit("name"), F.lit(4))
    added = F.transform(F.filter("free", lambda c: score(c) > math.log(limit / (1 - limit))), lambda c: F.struct(c["start"].alias("start"), F.element_at(kind, c["form"]).alias("kind"), c["end"].alias("end")))
    return held.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", added)).alias("spans"))
