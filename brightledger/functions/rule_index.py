"""Ordered rules as a table: an index finds the few rules that can fit a row, and the first of those that do fit wins.

A rule is a row (rule, label, one array of patterns per test). Tests are named as in ``channels``: a field takes any of its patterns,
``all_<field>`` needs all of them, ``not_<field>`` none, ``in_<field>`` is a list of values. Patterns are LIKE patterns, a leading ``~``
ignores case, and a null never matches. An empty or null array is no test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .channels import RULES

#: Letters of a pattern's beginning that the index keeps.
PREFIX = 3
EVERY = "*"


def channel_rules(spark: SparkSession, brand: str, shop: str, accounts: Mapping[str, int], own_tag: str = "shop", rules: Sequence[tuple[str, dict]] = RULES) -> DataFrame:
    """The channel rules as a table, with the shop's own names put in."""
    names = {"source": "source", "medium": "medium", "category": "category", "campaign": "all_campaign", "not_campaign": "not_campaign", "not_medium": "not_medium"}
    rows = []
    for i, (label, tests) in enumerate(rules):
        row = {names[t]: [p.replace("{brand}", brand).replace("{shop}", shop).replace("{own}", own_tag) for p in ps] for t, ps in tests.items() if t != "account"}
        listed = [accounts[a] for a in tests["account"] if a in accounts] if "account" in tests else None
        rows.append((i, label, *[row.get(n) for n in names.values()], [-1] if listed == [] else listed))  # a list of unknown accounts fits none
    return spark.createDataFrame(rows, ", ".join(["rule int, label string", *[f"{n} array<string>" for n in names.values()], "in_account array<long>"]))


def _keys(field: str, pattern: Column) -> Column:
    """The key of a pattern: a whole value, the beginning of one, or any value. Keys begin with the field and with c for patterns that ignore case."""
    fold = pattern.startswith("~")
    text = F.when(fold, F.substr(pattern, F.lit(2))).otherwise(pattern)
    head = F.regexp_extract(text, r"^[^%_\\]*", 0)
    kind = F.concat(F.lit(field), F.when(fold, "c").otherwise(""))
    return F.when(head == text, F.concat(kind, F.lit("="), text)).when(F.length(head) >= PREFIX, F.concat(kind, F.lit("^"), F.substring(head, 1, PREFIX))).otherwise(EVERY)


def _probes(field: str) -> list[Column]:
    return [F.concat(F.lit(field + fold + sign), part) for fold, value in (("", F.col(field)), ("c", F.lower(field))) for sign, part in (("=", value), ("^", F.substring(value, 1, PREFIX)))]


def _fits(test: str, fields: Sequence[str]) -> Column:
    kind, field = ("any", test) if test in fields else test.split("_", 1)
    value, patterns = F.col(field), F.col(f"__r_{test}")
    if kind == "in":
        held = F.array_contains(patterns, value)
    else:
        def like(p: Column) -> Column:
            return F.coalesce(F.when(p.startswith("~"), F.like(F.lower(value), F.substr(p, F.lit(2)))).otherwise(F.like(value, p)), F.lit(False))

        held = F.exists(patterns, like) if kind == "any" else F.forall(patterns, like) if kind == "all" else value.isNotNull() & ~F.exists(patterns, like)
    return F.coalesce(F.size(patterns), F.lit(0)).isin(0, -1) | F.coalesce(held, F.lit(False))


def classify(df: DataFrame, rules: DataFrame, fields: Sequence[str], name: str, otherwise: str = "Other") -> DataFrame:
    """``df`` with the label of the first rule that fits, or ``otherwise``, as column ``name``.

    Each different combination of ``fields`` is looked up once. A rule lies under the keys of the patterns of its most telling field (the first of
    ``fields`` that it tests), so exact values and beginnings are found by an equality join; only rules whose patterns begin
    with a wildcard are tried on every combination.
    """
    tests = [c for c in rules.columns if c not in ("rule", "label")]

    def keys(field: str) -> Column:
        return F.when(F.size(field) > 0, F.array_distinct(F.transform(field, lambda p: _keys(field, p))))

    anchors = [keys(f) for f in fields if f in tests]
    index = rules.select("rule", "label", *[F.col(t).alias(f"__r_{t}") for t in tests], F.explode(F.coalesce(*anchors, F.array(F.lit(EVERY)))).alias("__key"))
    combos = df.select(*fields).distinct()
    probes = [p for f in fields if f in tests for p in _probes(f)]
    asked = combos.select("*", F.explode(F.array_distinct(F.filter(F.array(*probes, F.lit(EVERY)), lambda k: k.isNotNull()))).alias("__key"))
    fit = reduce(lambda a, b: a & b, [_fits(t, fields) for t in tests], F.lit(True))
    found = asked.join(index, "__key").where(fit).groupBy(*fields).agg(F.min(F.struct("rule", "label"))["label"].alias(name))
    found = found.select(*[F.col(f).alias(f"__{f}") for f in fields], name)
    same = reduce(lambda a, b: a & b, [F.col(f).eqNullSafe(F.col(f"__{f}")) for f in fields])
    return df.join(found, same, "left").drop(*[f"__{f}" for f in fields]).withColumn(name, F.coalesce(name, F.lit(otherwise)))
