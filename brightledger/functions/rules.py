"""Ordered rule lists compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_type(path: Column, rules: Sequence[tuple[str, str]], default: str = "Other") -> Column:
    """Page type of a path by caller-supplied (substring, type) rules, first match wins."""
    out = F.lit(default)
    for text, label in reversed(rules):
        out = F.when(path.contains(text), label).otherwise(out)
    return F.when(path.isNull(), F.lit(None).cast("string")).otherwise(out)
