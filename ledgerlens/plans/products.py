"""Product, vehicle-model and channel analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.bins import bin_spine, cut
from ledgerlens.functions.exprs import (contains_safe, first_word, mean_of_sum, money,
                                        round6, starts_with_safe)
from ledgerlens.functions.rules import wheel_category
from ledgerlens.operators.lookup import lookup_small
from ledgerlens.operators.rollups import money_rollup, top_k
from ledgerlens.session import materialize
from ledgerlens.operators.scalars import with_row


def price_stats(df: DataFrame, group: str | None, price: str, distinct: str | None = None) -> DataFrame:
    """count, mean (exact), min, max of a price (+ distinct count) per group."""
    aggs = [F.count(F.lit(1)).alias("n"),
            round6(mean_of_sum(F.sum(money(price)), F.count(price))).alias("avg_price"),
            F.min(price).cast("double").alias("min_price"),
            F.max(price).cast("double").alias("max_price")]
    if distinct:
        aggs.append(F.countDistinct(distinct).alias(f"n_distinct_{distinct}"))
    if group is None:
        return df.agg(*aggs)
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(*aggs)


def price_ranges(df: DataFrame, price: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Counts per fixed price range, empty ranges kept, share of all rows."""
    label, order = cut(price, edges, labels)
    # grouped once including "no bin", so the row total comes from the same pass
    g_all = materialize(df.select(order.alias("bin_order")).groupBy("bin_order")
                        .agg(F.count(F.lit(1)).alias("n")))
    g = g_all.filter(F.col("bin_order").isNotNull())
    total = g_all.agg(F.sum("n").alias("_t"))
    return (bin_spine(df.sparkSession, labels).join(g, "bin_order", "left")
            .transform(with_row(total))
            .select("bin_order", "bin_label", F.coalesce("n", F.lit(0).cast("long")).alias("n"),
                    round6(F.try_divide(F.coalesce("n", F.lit(0)).cast("double"),
                                        F.col("_t").cast("double")) * 100).alias("pct")))


def wheel_profile(df: DataFrame, seats: str, price: str) -> DataFrame:
    return price_stats(df.withColumn("category", wheel_category(seats)), "category", price)


def word_profile(df: DataFrame, text: str, needle: str, prefix: str) -> DataFrame:
    """Per first word: count, names containing ``needle``, names starting
    with ``prefix`` (null-safe string predicates)."""
    return (df.withColumn("first_word", first_word(text))
            .filter(F.col("first_word").isNotNull()).groupBy("first_word")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(contains_safe(text, needle)).alias("n_contains"),
                 F.count_if(starts_with_safe(text, prefix)).alias("n_prefix")))


def top_pairs(fact: DataFrame, keys: Sequence[str], value: str, count_col: str, k: int,
              names: Sequence[tuple[DataFrame, str, str, str]], name_len: int = 50) -> DataFrame:
    """Top-k key combinations by revenue, each key resolved to a name."""
    g = money_rollup(fact, list(keys), value, total="revenue", count="n", count_col=count_col)
    out = top_k(g, "revenue", list(keys), k, rank_name="rank")
    for dim, dim_key, fact_key, name_col in names:
        out = lookup_small(out, fact_key, dim.select(dim_key, name_col), dim_key, [name_col],
                           default={name_col: "Unknown"}, row_key=list(keys))
        out = out.withColumn(name_col, F.substring(name_col, 1, name_len))
    return out
