"""Distinct counts under many conditions without copying rows.

Several ``COUNT(DISTINCT IF(..))`` in one aggregate make Spark expand each row once per
count. Here rows first shrink to one per (dimensions, visitor, session) with boolean
flags, then the flags are added up, so every exchange carries pre-aggregated rows and a
visitor with very many hits is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def flag_report(df: DataFrame, dims: list[str], visitors: Mapping[str, Column], sessions: Mapping[str, Column] | None = None,
                sums: Mapping[str, Column] | None = None, orders: str | None = None,
                visitor: str = "fullVisitorId", session: str = "visitId", order: str = "transactionId") -> DataFrame:
    """One row per ``dims``: distinct visitors and sessions per flag, sums, distinct orders."""
    sessions, sums = dict(sessions or {}), dict(sums or {})

    def flag(c: Column) -> Column:
        return F.max(F.coalesce(c, F.lit(False)))

    keys = [*dims, visitor] + ([session] if sessions else [])
    step = df.groupBy(*keys).agg(*[flag(c).alias(n) for n, c in visitors.items()],
                                 *[flag(c).alias(n) for n, c in sessions.items()],
                                 *[F.sum(c).alias(n) for n, c in sums.items()])
    if sessions:
        step = step.groupBy(*dims, visitor).agg(*[F.max(n).alias(n) for n in visitors],
                                                *[F.sum(F.col(n).cast("long")).alias(n) for n in sessions],
                                                *[F.sum(n).alias(n) for n in sums])
    known = F.col(visitor).isNotNull()
    out = step.groupBy(*dims).agg(*[F.sum((F.col(n) & known).cast("long")).alias(n) for n in visitors],
                                  *[F.sum(F.col(n)).alias(n) for n in sessions],
                                  *[F.sum(n).alias(n) for n in sums])
    if not orders:
        return out
    placed = df.where(F.col(order).isNotNull()).groupBy(*dims, order).agg(F.lit(1).alias("__one"))
    placed = placed.groupBy(*dims).agg(F.count(F.lit(1)).alias(orders))
    names = [*visitors, *sessions, *sums]
    both = out.unionByName(placed, allowMissingColumns=True)
    return both.groupBy(*dims).agg(*[F.sum(n).alias(n) for n in names],
                                   F.coalesce(F.sum(orders), F.lit(0)).cast("long").alias(orders))
