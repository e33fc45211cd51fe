"""Per-customer value tables: volume vs margin, and the wide feature table.

Order lines are pre-aggregated per order before they meet the orders table
(one row per order crosses the join shuffle instead of one per line), and
every per-customer sum comes out of a single group-by. Distinct products and
channels are bitmap words per customer: no order and no customer holds a list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.exprs import money, mean_of_sum, round6, round_half_even
from ledgerlens.operators import bitmaps, labels
from ledgerlens.operators.lookup import lookup
from ledgerlens.operators.scalars import with_row

KEY = "customer_key"


def last_non_null(value: str, *order: str):
    """``groupby.last()``: newest non-null value, newest by ``order``.
    Rows whose value is null get a null ordering and are ignored."""
    ordering = F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in order]))
    return F.max_by(F.col(value), ordering)


def _with_last_label(facts: DataFrame, company: str, aggs: list, name: str) -> DataFrame:
    """Per-customer aggregate with the last non-null company; its labels are coded while they are
    aggregated, so that every state is fixed-width (text states only beyond MAX_LABELS labels)."""
    known = labels.dictionary(facts, company)
    if known is None:
        return facts.groupBy(KEY).agg(*aggs, last_non_null(company, "order_date", "_order").alias(name))
    return (facts.groupBy(KEY).agg(*aggs, labels.last_label(company, known, "order_date", "_order").alias(name))
            .withColumn(name, labels.decode(F.col(name), known)))


def order_lines(lines: DataFrame, order_key: str, price: str, qty: str) -> DataFrame:
    """(order_key, volume, duration) per order: line price sum and quantity sum."""
    return (lines.groupBy(F.col(order_key).alias("_order"))
            .agg(F.sum(money(price)).alias("volume"), F.sum(qty).alias("duration")))


def order_facts(orders: DataFrame, lines: DataFrame, *, key: str, order_id: str,
                date: str, amount: str, company: str,
                line_order_key: str, line_price: str, line_qty: str) -> DataFrame:
    per_order = order_lines(lines, line_order_key, line_price, line_qty)
    o = orders.select(F.col(key).alias(KEY), F.col(order_id).alias("_order"),
                      F.to_date(date).alias("order_date"), money(amount).alias("margin"),
                      F.col(company).alias("company"))
    return (o.join(per_order, "_order", "left")
            .withColumn("volume", F.coalesce("volume", F.lit(0).cast("decimal(28,2)")))
            .filter(F.col(KEY).isNotNull()))


def volume_margin(facts: DataFrame, customers: DataFrame, customer_key: str,
                  attrs: Sequence[str]) -> DataFrame:
    per = _with_last_label(facts, "company", [F.sum("margin").alias("_margin"), F.sum("volume").alias("_volume"),
                                              F.count("_order").alias("order_count")], "company")
    per = per.select(
        KEY, F.col("_margin").cast("double").alias("total_margin"),
        F.col("_volume").cast("double").alias("total_volume"), "order_count", "company",
        round6(mean_of_sum("_margin", "order_count")).alias("avg_margin"),
        round6(mean_of_sum("_volume", "order_count")).alias("avg_volume"))
    return lookup(per, KEY, customers, customer_key, list(attrs))


def volume_margin_corr(vm: DataFrame) -> DataFrame:
    return vm.agg(F.count(F.lit(1)).alias("n_customers"),
                  round6(F.corr("total_volume", "total_margin")).alias("corr_volume_margin"))


def volume_margin_by_tier(vm: DataFrame, tier: str) -> DataFrame:
    """Tier means rounded half-even to whole numbers, plus the count."""
    g = (vm.filter(F.col(tier).isNotNull()).groupBy(tier)
         .agg(F.sum(money("total_volume")).alias("_v"), F.sum(money("total_margin")).alias("_m"),
              F.sum("order_count").alias("_o"), F.count(KEY).alias("count")))
    return g.select(tier,
                    round_half_even(mean_of_sum("_v", "count"), 0).alias("avg_volume"),
                    round_half_even(mean_of_sum("_m", "count"), 0).alias("avg_margin"),
                    round_half_even(mean_of_sum("_o", "count"), 0).alias("avg_orders"),
                    "count")


def member_counts(facts: DataFrame, lines: DataFrame, line_order_key: str,
                  members: Mapping[str, str]) -> DataFrame:
    """Per customer, the distinct non-null values of line columns (name -> column).

    Integer columns become bitmap words, counted for all of them in one pass over the
    joined lines; columns of other types are de-duplicated with the customer.
    Customers without lines have no row.
    """
    owned = (lines.select(F.col(line_order_key).alias("_order"), *[F.col(c).alias(n) for n, c in members.items()])
             .join(facts.select(KEY, "_order"), "_order"))
    coded = {n: n for n in members if bitmaps.is_integer(owned, n)}
    out = bitmaps.distinct_counts(owned, coded, rows="_lines", groups=[KEY]).drop("_lines")
    for n in members:
        if n not in coded:
            one = (owned.filter(F.col(n).isNotNull()).select(KEY, n).distinct()
                   .groupBy(KEY).agg(F.count(F.lit(1)).alias(n)))
            out = out.join(one, KEY, "left").withColumn(n, F.coalesce(n, F.lit(0)).cast("long"))
    return out


def feature_aggregates(facts: DataFrame, members: DataFrame) -> DataFrame:
    """The wide per-customer aggregate (count, sum/mean/std, min/max dates,
    mean duration, last company, distinct products / channels / employees).

    ``members`` has ``n_products`` and ``n_channels`` per customer (``member_counts``).
    """
    per_order = _with_last_label(facts, "company", [
        F.count("_order").alias("order_count"),
        F.sum("margin").alias("_margin_sum"),
        F.stddev_samp(F.col("margin").cast("double")).alias("_margin_std"),
        F.sum("volume").alias("_volume_sum"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("duration").alias("_dur_sum"), F.count("duration").alias("_dur_n")], "last_company")

    per_order = per_order.select(
        KEY, "order_count",
        F.col("_margin_sum").cast("double").alias("margin_sum"),
        round6(mean_of_sum("_margin_sum", "order_count")).alias("margin_mean"),
        round6("_margin_std").alias("margin_std"),
        F.col("_volume_sum").cast("double").alias("volume_sum"),
        round6(mean_of_sum("_volume_sum", "order_count")).alias("volume_mean"),
        "first_order_date", "last_order_date",
        round6(mean_of_sum("_dur_sum", "_dur_n")).alias("duration_mean"),
        "last_company")
    # employee and detail channel are the same column here
    return (per_order.join(members.select(KEY, "n_products", "n_channels"), KEY, "left")
            .withColumn("n_employees", F.col("n_channels")))


def feature_table(scored: DataFrame, customers: DataFrame, customer_key: str,
                  features: DataFrame, order_dates: DataFrame) -> DataFrame:
    """RFM ⟕ customer ⟕ features, tenure columns, numeric nulls -> 0.

    The latest order date is a global max over ``order_dates`` (all orders,
    one column), not over the per-customer table or the line-joined facts.
    """
    cust = customers.withColumnRenamed(customer_key, KEY)
    cust_cols = [c for c in cust.columns if c != KEY]
    cust = cust.groupBy(KEY).agg(*[F.min(c).alias(c) for c in cust_cols])
    global_last = order_dates.agg(F.max("order_date").alias("_global_last"))
    t = (scored.join(cust, KEY, "left").join(features, KEY, "left")
         .transform(with_row(global_last))  # one-row scalar
         .withColumn("customer_tenure_days",
                     F.datediff("last_order_date", "first_order_date").cast("long"))
         .withColumn("days_since_first_order",
                     F.datediff("_global_last", "first_order_date").cast("long"))
         .withColumn("days_since_last_order", F.col("recency"))
         .drop("_global_last"))
    numeric = [f.name for f in t.schema.fields
               if isinstance(f.dataType, T.NumericType)]
    return t.na.fill(0, subset=numeric)


def feature_summary(ft: DataFrame) -> DataFrame:
    n_features = len(ft.columns)
    return ft.agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.lit(n_features).cast("long").alias("n_features"),
        round6(F.avg("order_count")).alias("avg_orders"),
        round6(F.avg("customer_tenure_days")).alias("avg_tenure_days"),
        round6(F.avg("n_products")).alias("avg_products"),
        F.min("recency").alias("min_recency"), F.max("recency").alias("max_recency"),
        round6(F.avg("recency")).alias("mean_recency"),
        F.min("frequency").alias("min_frequency"), F.max("frequency").alias("max_frequency"),
        round6(F.avg("frequency")).alias("mean_frequency"),
        F.min("monetary").cast("double").alias("min_monetary"),
        F.max("monetary").cast("double").alias("max_monetary"),
        round6(mean_of_sum(F.sum("monetary"), F.count("monetary"))).alias("mean_monetary"),
    )
