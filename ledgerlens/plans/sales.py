"""Revenue rollups by channel, product, employee, branch and company.

Each is group-by → (top-k) → name lookup. The group-by is a partial + final
hash aggregate (map-side combine), so only one row per key and partition
crosses the shuffle; top-k runs as TakeOrderedAndProject; the name lookup
joins only the k survivors.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import money, pct, truncate, round6, mean_of_sum
from ledgerlens.operators.lookup import lookup, lookup_small, dedup_dimension
from ledgerlens.operators.rollups import bottom_k, money_rollup, top_k
from ledgerlens.operators.selection import Place, find
from ledgerlens.session import materialize
from ledgerlens.operators.scalars import with_row


def top_by_revenue(fact: DataFrame, key: str, value: str, count_col: str, k: int,
                   dim: DataFrame, dim_key: str, name_col: str, *,
                   key_name: str, name_len: int | None = 40,
                   bottom: int = 0) -> DataFrame:
    """Top ``k`` keys by summed ``value`` (and optionally the last ``bottom``),
    with the looked-up name (default 'Unknown', truncated) and a rank.

    Output: key_name, revenue, n, name, rank, position ('top'/'bottom').
    """
    g = (money_rollup(fact, [key], value, total="revenue", count="n", count_col=count_col)
         .withColumnRenamed(key, key_name))
    if bottom:  # read by both ends: checkpoint the per-key table once
        g = materialize(g)
    parts = [top_k(g, "revenue", key_name, k, rank_name="rank")
             .withColumn("position", F.lit("top"))]
    if bottom:
        parts.append(bottom_k(g, "revenue", key_name, bottom, rank_name="rank")
                     .withColumn("position", F.lit("bottom")))
    small = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # a key can sit in both the top and the bottom list when there are few keys
    named = lookup_small(small, key_name, dim.select(dim_key, name_col), dim_key, [name_col],
                         default={name_col: "Unknown"}, row_key=[key_name, "position"])
    name = truncate(name_col, name_len) if name_len else F.col(name_col)
    return named.select(key_name, "revenue", "n", name.alias("name"), "rank", "position")


def with_share(df: DataFrame, value: str, name: str) -> DataFrame:
    df = materialize(df)  # read twice (rows and total)
    total = df.agg(F.sum(value).alias("_ll_t"))  # one row
    return df.transform(with_row(total)).withColumn(name, pct(value, "_ll_t")).drop("_ll_t")


def top_fraction_share(per_key: DataFrame, key: str, value: str, fraction: float,
                       total: DataFrame) -> DataFrame:
    """Share of ``total`` held by the first int(n * fraction) keys by value desc.

    The sum of the first k is selected by refined histograms: which of several keys
    of one value come first does not change it.
    """
    per_key = materialize(per_key)
    k = int(per_key.count() * Decimal(str(fraction)))
    place, = find(per_key, value, lambda x: [Place(rank=min(k, x.n), descending=True)])
    top = per_key.sparkSession.createDataFrame([(place.total,)], "_ll_top decimal(38,6)")
    return top.transform(with_row(total))


def employee_map(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """(s_suppkey, branch_key, branch, company) – dictionary maps chained on the
    dimension side, so the fact table is joined only once."""
    s = lookup(supplier.select("s_suppkey", "s_nationkey"), "s_nationkey", nation,
               "n_nationkey", ["n_name", "n_regionkey"])
    s = lookup(s, "n_regionkey", region, "r_regionkey", ["r_name"])
    return (dedup_dimension(s, "s_suppkey", ["s_nationkey", "n_name", "r_name"])
            .select("s_suppkey", F.col("s_nationkey").alias("branch_key"),
                    F.col("n_name").alias("branch"), F.col("r_name").alias("company")))


def per_key_totals(fact: DataFrame, key: str, value: str, count_col: str) -> DataFrame:
    """Partial rollup (sum as decimal, count of ``count_col``, count of values) to be
    re-aggregated after a dimension join: the fact is reduced before it meets the map."""
    return (fact.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.sum(money(value)).alias("_sum"), F.count(count_col).alias("_cnt"),
                 F.count(value).alias("_vals")))


def rollup_through_map(totals: DataFrame, key: str, mapping: DataFrame, map_key: str,
                       group: str, name: str) -> DataFrame:
    """Re-aggregate per-key totals to the mapped group (unmapped keys drop out)."""
    j = totals.join(mapping.withColumnRenamed(map_key, key), key, "left")
    g = (j.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias(name))
         .agg(F.sum("_sum").alias("_sum"), F.sum("_cnt").alias("n"), F.sum("_vals").alias("_vals"),
              F.count(F.lit(1)).alias("n_keys")))
    return g.select(name, F.coalesce(F.col("_sum"), F.lit(0)).cast("double").alias("revenue"),
                    "n", "n_keys",
                    round6(mean_of_sum("_sum", "_vals")).alias("avg_revenue"))
