"""Ordered and time-distance operators that split a hot key by time.

A plain window partitioned by key alone sends all rows of one key to one task. The
functions below partition by key *and* a time bucket, and carry the little state that
crosses a bucket boundary through a table with one row per key and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import unit_no
from ..sources.targets import stage


def numbered(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Row number per key; ``bucket`` must not decrease along ``order``."""
    parted = df.withColumn("__b", bucket)
    sizes = parted.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inner = Window.partitionBy(*keys, "__b").orderBy(*order)
    return (parted.withColumn("__rn", F.row_number().over(inner))
            .join(offsets, [*keys, "__b"])
            .withColumn(name, F.col("__rn") + F.col("__off"))
            .drop("__b", "__rn", "__off"))


def neighbours(df: DataFrame, keys: list[str], bucket: Column, order: list[str], value: Column,
               before: str | None = None, after: str | None = None) -> DataFrame:
    """``lag`` and ``lead`` of ``value`` by one row within the key, under the names given.

    Inside a bucket they are plain windows; the rows at the edges of a bucket take the value
    from the nearest other bucket of the same key. ``order`` must be total within the key for
    a defined answer, and ``bucket`` must not decrease along it. Keys match null to null.
    """
    parted = df.withColumn("__b", bucket).withColumn("__v", F.struct(value.alias("v")))
    inside = Window.partitionBy(*keys, "__b").orderBy(*order)
    edge = F.struct(*[F.col(o) for o in order])
    ends = parted.groupBy(*keys, "__b").agg(F.min_by("__v", edge).alias("__lo"), F.max_by("__v", edge).alias("__hi"))
    across = Window.partitionBy(*keys).orderBy("__b")
    carried = ends.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__b").alias("__cb"),
                          F.lag("__hi").over(across).alias("__c_before"), F.lead("__lo").over(across).alias("__c_after"))
    cond = F.col("__b").eqNullSafe(F.col("__cb"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    near = parted.withColumns({"__n_before": F.lag("__v").over(inside), "__n_after": F.lead("__v").over(inside)})
    out = near.join(carried, cond, "left")
    for side, name in (("before", before), ("after", after)):
        if name:
            out = out.withColumn(name, F.coalesce(f"__n_{side}", f"__c_{side}")["v"])
    return out.drop("__b", "__v", "__n_before", "__n_after", "__c_before", "__c_after", "__cb", *[f"__k_{k}" for k in keys])


def last_before(probes: DataFrame, facts: DataFrame, keys: list[str], at: str, since: str,
                rank: list[str], payload: list[str], after: bool = False) -> DataFrame:
    """As-of join: for each probe the payload of the last fact strictly before ``at``.

    Facts of one key are ordered by (``since``, ``rank``). With ``after`` it is the first fact
    strictly later. Probes and facts are split by key and day; the nearest fact of other days
    comes from a table of one row per key and day. Probes without such a fact keep null payloads.
    """
    best = F.min if after else F.max
    fact = F.struct(F.col(since).alias("__t"), *[F.col(r).alias(f"__r{i}") for i, r in enumerate(rank)],
                    *[F.col(p) for p in payload])
    day_facts = facts.where(F.col(since).isNotNull()).select(
        *keys, F.to_date(since).alias("__day"), F.col(since).cast("timestamp_ntz").alias("__at"), fact.alias("__fact"))
    asked = probes.select(*keys, F.to_date(at).alias("__day"), F.col(at).cast("timestamp_ntz").alias("__at")).distinct()
    none = F.lit(None).cast(day_facts.schema["__fact"].dataType)
    spine = (day_facts.select(*keys, "__day", "__fact")
             .unionByName(asked.select(*keys, "__day").distinct().withColumn("__fact", none))
             .groupBy(*keys, "__day").agg(best("__fact").alias("__end")))
    step = F.col("__day").desc() if after else F.col("__day")
    others = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    carried = spine.select(*keys, "__day", best("__end").over(others).alias("__carry"))
    both = (day_facts.withColumn("__probe", F.lit(False))
            .unionByName(asked.withColumn("__fact", none).withColumn("__probe", F.lit(True))))
    moment = F.col("__at").desc() if after else F.col("__at")
    today = (Window.partitionBy(*keys, "__day").orderBy(moment, F.col("__probe").desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (both.withColumn("__same", best("__fact").over(today)).where("__probe")
             .join(carried, [*keys, "__day"], "left")
             .select(*keys, "__at", F.coalesce("__same", "__carry").alias("__hit")))
    out = probes.withColumn("__at", F.col(at).cast("timestamp_ntz")).join(found, [*keys, "__at"], "left")
    return out.select(*[F.col(c) for c in probes.columns],
                      *[F.col("__hit")[p].alias(p) for p in payload])


def sweep(probes: DataFrame, facts: DataFrame, keys: list[str], at: str, since: str, payload: list[str], most: int = 1_000_000) -> DataFrame:
    """As-of lookups to both sides in one pass over probes and facts together.

    Each probe gains ``before``, the last fact of its key strictly earlier, and ``after``, the first strictly later, as structs of ``since``
    and ``payload`` (which ranks facts of one moment), and ``same``, the number of facts at its own moment. Keys of over ``most`` rows
    are split by day, and what lies on other days comes from one row per key and day; the others are one group each. Probes and
    facts without a time or with a null key are dropped.
    """
    fact = F.struct(F.col(since).cast("timestamp_ntz").alias(since), *[F.col(p) for p in payload])
    probe = F.struct(*[F.col(c) for c in probes.columns])

    def events(df: DataFrame, time: str, value: Column, name: str) -> DataFrame:
        present = F.col(time).isNotNull()
        for k in keys:
            present = present & F.col(k).isNotNull()
        micros = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', CAST({time} AS timestamp_ntz))")
        return df.where(present).select(*keys, F.to_date(time).alias("__day"), micros.alias("__us"), value.alias(name))

    def looked_up(rows: DataFrame, groups: list[str]) -> DataFrame:
        up = Window.partitionBy(*groups).orderBy("__us")
        down = Window.partitionBy(*groups).orderBy(F.col("__us").desc()).rangeBetween(Window.unboundedPreceding, -1)
        seen = rows.select("*", F.max("__fact").over(up.rangeBetween(Window.unboundedPreceding, -1)).alias("before"), F.min("__fact").over(down).alias("after"), F.count("__fact").over(up.rangeBetween(0, 0)).alias("same"))
        return seen.where("__probe IS NOT NULL")

    both = events(facts, since, fact, "__fact").unionByName(events(probes, at, probe, "__probe"), allowMissingColumns=True)

    def frequent(df: DataFrame, groups: list[str]) -> DataFrame:
        return stage(df.groupBy(*groups).agg(F.count("*").alias("__n")).where(F.col("__n") > most).drop("__n"))

    # a key of many rows has a first part of many; there are far fewer of these, so they are counted first
    hot = frequent(both, keys[:1])
    if len(keys) > 1 and hot.take(1):
        hot = frequent(both.join(hot, keys[:1], "left_semi"), keys)
    if not hot.take(1):
        return looked_up(both, keys).select("__probe.*", "before", "after", "same")
    cold, split = looked_up(both.join(hot, keys, "left_anti"), keys), both.join(hot, keys, "left_semi")
    days = split.groupBy(*keys, "__day").agg(F.max("__fact").alias("__hi"), F.min("__fact").alias("__lo"))
    earlier = Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col("__day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(*keys, "__day", F.max("__hi").over(earlier).alias("__from"), F.min("__lo").over(later).alias("__to"))
    found = looked_up(split, [*keys, "__day"]).join(carried, [*keys, "__day"])
    found = found.select("__probe.*", F.coalesce("before", "__from").alias("before"), F.coalesce("after", "__to").alias("after"), "same")
    return cold.select("__probe.*", "before", "after", "same").unionByName(found)


def earliest_within(probes: DataFrame, facts: DataFrame, keys: list[str], at: str, since: str,
                    minutes: int, pick: Column, name: str) -> DataFrame:
    """Smallest ``pick`` among facts at or before a probe and 0 to ``minutes`` minute boundaries away.

    Probes without such a fact are dropped. Facts of earlier minutes shrink to one row per
    key and minute. The minute axis is cut in blocks of ``minutes``; the window that ends
    before a probe's minute is a suffix of one block and a prefix of the next, so two running
    minima answer it without forming pairs, and a block of one key never holds more than
    ``minutes`` fact rows. Facts of the probe's own minute are compared by exact time.
    """
    block = F.lit(minutes)
    timed = facts.where(F.col(since).isNotNull()).select(
        *keys, unit_no("MINUTE", since).alias("__m"), F.col(since).alias("__t"), pick.alias("__v"))
    asked = probes.where(F.col(at).isNotNull()).select(*keys, unit_no("MINUTE", at).alias("__m"), F.col(at).alias("__t")).distinct()
    asked_minutes = asked.select(*keys, "__m").distinct()

    def place(df: DataFrame, shift: int = 0) -> list[Column]:
        return [*[F.col(k) for k in keys], (F.floor(F.col("__m") / block) + shift).alias("__blk"),
                F.pmod("__m", block).alias("__off")]

    per_minute = timed.groupBy(*keys, "__m").agg(F.min("__v").alias("__v"))
    rows = (per_minute.select(*place(per_minute), F.col("__v").alias("__head"))
            .unionByName(per_minute.select(*place(per_minute, 1), F.col("__v").alias("__tail")), allowMissingColumns=True)
            .unionByName(asked_minutes.select(*place(asked_minutes), F.lit(True).alias("__probe")), allowMissingColumns=True)
            .groupBy(*keys, "__blk", "__off")
            .agg(F.min("__head").alias("__head"), F.min("__tail").alias("__tail"), F.max("__probe").alias("__probe")))
    up = Window.partitionBy(*keys, "__blk").orderBy("__off").rowsBetween(Window.unboundedPreceding, -1)
    down = (Window.partitionBy(*keys, "__blk").orderBy(F.col("__off").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = (rows.withColumn("__p", F.min("__head").over(up)).withColumn("__s", F.min("__tail").over(down))
              .where("__probe")
              .select(*keys, (F.col("__blk") * block + F.col("__off")).alias("__m"), F.least("__p", "__s").alias("__before")))
    none = F.lit(None).cast(timed.schema["__v"].dataType)
    same = (timed.join(asked_minutes, [*keys, "__m"], "left_semi").withColumn("__q", F.lit(0))
            .unionByName(asked.withColumn("__v", none).withColumn("__q", F.lit(1))))
    along = (Window.partitionBy(*keys, "__m").orderBy("__t", "__q")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = same.withColumn("__same", F.min("__v").over(along)).where("__q = 1").select(*keys, "__m", "__t", "__same")
    best = (within.join(before, [*keys, "__m"], "left").withColumn(name, F.least("__same", "__before"))
            .where(F.col(name).isNotNull()).select(*keys, "__t", name))
    return probes.withColumn("__t", F.col(at)).join(best, [*keys, "__t"]).drop("__t")


def running(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], values: dict[str, tuple[str, Column]],
            backward: bool = False, inclusive: bool = True) -> DataFrame:
    """Running ``max``, ``min`` or ``sum`` columns along ``order``, split by key and bucket.

    ``values`` maps a new column to (how, value). ``backward`` runs from the end and
    ``inclusive=False`` leaves the own row out. ``bucket`` must not decrease along ``order``.
    """
    fns = {"max": F.max, "min": F.min, "sum": F.sum}
    parted = df.withColumn("__b", bucket).withColumns({f"__v_{n}": v for n, (_, v) in values.items()})
    along = [o.desc() for o in order] if backward else order
    stop = Window.currentRow if inclusive else -1
    inner = Window.partitionBy(*keys, "__b").orderBy(*along).rowsBetween(Window.unboundedPreceding, stop)
    ends = parted.groupBy(*keys, "__b").agg(*[fns[how](f"__v_{n}").alias(f"__e_{n}") for n, (how, _) in values.items()])
    step = F.col("__b").desc() if backward else F.col("__b")
    across = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "__b", *[fns[how](f"__e_{n}").over(across).alias(f"__c_{n}") for n, (how, _) in values.items()])
    out = parted.withColumns({f"__i_{n}": fns[how](f"__v_{n}").over(inner) for n, (how, _) in values.items()})
    out = out.join(carried, [*keys, "__b"], "left")

    def total(n: str, how: str) -> Column:
        a, b = F.col(f"__i_{n}"), F.col(f"__c_{n}")
        if how == "sum":
            return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
        return F.greatest(a, b) if how == "max" else F.least(a, b)

    out = out.withColumns({n: total(n, how) for n, (how, _) in values.items()})
    return out.drop("__b", *[f"__{p}_{n}" for n in values for p in "vic"])
