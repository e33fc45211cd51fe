"""Dimension lookups (dictionary ``map`` and name lookups) as joins.

A dimension is first reduced to one row per key, so a duplicated key can
never fan a fact row out. Without file order there is no "last duplicate";
the smallest attribute value is taken, which is deterministic.

Broadcast policy: a fact-to-dimension lookup carries no hint. Catalyst's
``spark.sql.autoBroadcastJoinThreshold`` (estimated size) and AQE (actual
shuffle size) decide, and a dimension that outgrows the threshold falls back
to a sort-merge join. Only sides whose size is bounded by construction
(top-k results, per-partition offset tables) are hinted; one-row results
are attached as scalar subqueries (``operators.scalars``), not joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_dimension(dim: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """One row per non-null key: ``groupBy(key).agg(min(attr))``."""
    return (dim.filter(F.col(key).isNotNull())
            .groupBy(key).agg(*[F.min(a).alias(a) for a in attrs]))


def lookup(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
           attrs: Sequence[str], default: dict | None = None) -> DataFrame:
    """Left join of fact rows to deduplicated dimension attributes.

    Unmatched rows get ``default[attr]`` (or null).
    """
    d = dedup_dimension(dim, dim_key, attrs)
    if dim_key != fact_key:
        d = d.withColumnRenamed(dim_key, fact_key)
    out = fact.join(d, fact_key, "left")
    for a, v in (default or {}).items():
        out = out.withColumn(a, F.coalesce(F.col(a), F.lit(v)))
    return out


def lookup_small(small: DataFrame, small_key: str, dim: DataFrame, dim_key: str,
                 attrs: Sequence[str], default: dict | None = None,
                 row_key: Sequence[str] | None = None) -> DataFrame:
    """Name lookup for a result whose row count is bounded (top-k).

    ``dim RIGHT JOIN broadcast(small)``: the dimension is streamed once,
    unshuffled, against the broadcast k rows; duplicate dimension keys are
    then collapsed on the (at most k x duplicates) joined rows by grouping on
    the small row itself. ``small`` is read once and the full dimension is
    never shuffled or de-duplicated. ``row_key`` names the columns that
    identify a row of ``small`` (default: the lookup key).
    """
    d = dim.select(F.col(dim_key).alias(small_key), *attrs).filter(F.col(small_key).isNotNull())
    joined = d.join(F.broadcast(small), small_key, "right")
    # every copy of a small row carries identical small columns: first() is exact
    keys = list(row_key) if row_key else [small_key]
    others = [c for c in small.columns if c not in keys]
    out = joined.groupBy(*keys).agg(*[F.first(c).alias(c) for c in others],
                                    *[F.min(a).alias(a) for a in attrs])
    for a, v in (default or {}).items():
        out = out.withColumn(a, F.coalesce(F.col(a), F.lit(v)))
    return out
