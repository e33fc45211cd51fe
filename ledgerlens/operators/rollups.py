"""Group rollups, value counts, shares and top-k with explicit tie rules.

pandas drops null group keys, so every grouping here filters them first.
Every ordering ends in the key, so ties repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import money, pct, round6, mean_of_sum
from ledgerlens.session import materialize
from ledgerlens.operators.scalars import with_row


def non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def value_counts(df: DataFrame, col: str, count_name: str = "n",
                 share_name: str | None = None, share_of_rows: bool = False,
                 digits: int = 6) -> DataFrame:
    """``value_counts()``: null excluded; optional share in percent.

    ``share_of_rows=False`` is ``normalize=True`` (share of non-null values);
    ``True`` is ``count / len(df) * 100`` (null rows stay in the denominator).
    With a share, the table is grouped once *including* the null key (so the
    row total comes from the same pass), checkpointed (it has one row per
    distinct value and is read twice), and the total is a one-row aggregate
    over it.
    """
    if share_name is None:
        return non_null_keys(df, [col]).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    grouped = materialize(df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name)))
    counts = grouped.filter(F.col(col).isNotNull())
    total = (grouped if share_of_rows else counts).agg(F.sum(count_name).alias("_ll_total"))
    return (counts.transform(with_row(total))  # one-row scalar
            .withColumn(share_name, pct(count_name, "_ll_total", digits))
            .drop("_ll_total"))


def money_rollup(df: DataFrame, keys: Sequence[str], value: str, *,
                 total: str | None = "total", count: str | None = "n",
                 mean: str | None = None, count_col: str | None = None) -> DataFrame:
    """Group sum (exact decimal) + non-null count (+ mean) of a money column."""
    v = money(value)
    aggs: list[Column] = []
    if total:
        aggs.append(F.sum(v).alias("_ll_sum"))
    if count:
        aggs.append(F.count(F.col(count_col or value)).alias(count))
    if mean:
        aggs.append(F.count(F.col(value)).alias("_ll_n"))
    out = non_null_keys(df, keys).groupBy(*keys).agg(*aggs)
    if mean:
        out = out.withColumn(mean, round6(mean_of_sum("_ll_sum", "_ll_n"))).drop("_ll_n")
    if total:
        out = out.withColumn(total, F.coalesce(F.col("_ll_sum"), F.lit(0)).cast("double")).drop("_ll_sum")
    return out


def top_k(df: DataFrame, metric: str, key: str | Sequence[str], k: int,
          ascending: bool = False, rank_name: str | None = "rank") -> DataFrame:
    """First ``k`` rows by metric (desc by default), ties by key ascending.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition keeps
    its own k best and only those reach the final task. The rank is
    numbered over the k survivors only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    m = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    order = [m] + [F.col(c).asc_nulls_last() for c in keys]
    top = df.orderBy(*order).limit(k)
    if rank_name:
        top = top.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return top


def bottom_k(df: DataFrame, metric: str, key: str | Sequence[str], k: int,
             rank_name: str = "rank") -> DataFrame:
    """``sort_values(desc).tail(k)``: the last k rows of the descending order,
    numbered by their position counted from the end (1 = very last)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(metric).asc_nulls_first()] + [F.col(c).desc_nulls_first() for c in keys]
    bottom = df.orderBy(*order).limit(k)
    return bottom.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def describe(df: DataFrame, value: str, prefix: str = "") -> DataFrame:
    """Eight-number ``describe()``: count, mean, std, min, 25/50/75 %, max.

    Exact percentiles (not ``summary()``'s approximations) from the distributed
    quantile operator; the mean is an exact decimal sum over the
    count.
    """
    from ledgerlens.operators.ranks import exact_quantiles

    v = F.col(value)
    moments = df.agg(
        F.count(v).alias(f"{prefix}count"),
        round6(mean_of_sum(F.sum(v.cast("decimal(38,6)")), F.count(v))).alias(f"{prefix}mean"),
        round6(F.stddev_samp(v)).alias(f"{prefix}std"),
        F.min(v).cast("double").alias(f"{prefix}min"),
        F.max(v).cast("double").alias(f"{prefix}max"))
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], prefix="_ll_q")
    return moments.transform(with_row(q)).select(  # one row each
        f"{prefix}count", f"{prefix}mean", f"{prefix}std", f"{prefix}min",
        round6("_ll_q0").alias(f"{prefix}p25"), round6("_ll_q1").alias(f"{prefix}p50"),
        round6("_ll_q2").alias(f"{prefix}p75"), f"{prefix}max")
