"""Recency / frequency / monetary scores, segments, segment summary, VIP list.

Scale notes: the per-customer base is one partial+final hash aggregate over
orders. The two rank-based scores need four rows of a global order each; they
are selected by refined histograms, so no customer is sorted or moved. Recency edges use the
exact ``percentile`` aggregate, whose state is one counter per distinct day
(bounded by the calendar, not the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.bins import cut
from ledgerlens.functions.exprs import money, qcut_rank_bin, round_half_even, mean_of_sum
from ledgerlens.functions.rules import VIP_SEGMENTS, rfm_segment, vip_tier
from ledgerlens.operators.lookup import lookup_small
from ledgerlens.operators.ranks import exact_quantiles, global_row_number
from ledgerlens.operators.rollups import top_k
from ledgerlens.operators.selection import bin_edges, bin_of
from ledgerlens.session import materialize
from ledgerlens.operators.scalars import with_row

KEY = "customer_key"
R_PROBS = [0.2, 0.4, 0.6, 0.8]


def order_frame(orders: DataFrame, key: str, order_id: str, date: str, amount: str) -> DataFrame:
    """Orders reduced to (customer_key, order_id, order_date, amount)."""
    return (orders.select(F.col(key).alias(KEY), F.col(order_id).alias("order_id"),
                          F.to_date(date).alias("order_date"), money(amount).alias("amount"))
            .filter(F.col(KEY).isNotNull()))


def rfm_base(orders: DataFrame, key: str = "o_custkey", order_id: str = "o_orderkey",
             date: str = "o_orderdate", amount: str = "o_totalprice") -> DataFrame:
    """(customer_key, recency, frequency, monetary[decimal]).

    Reference date = latest order date + 1 day. Customers without any valid
    date have no recency and are left out (they cannot be scored). Orders are read
    once: the customer table is materialised, and the latest date is read off it.
    """
    o = order_frame(orders, key, order_id, date, amount)
    base = materialize(o.groupBy(KEY).agg(
        F.max("order_date").alias("_last"), F.count("order_id").alias("frequency"),
        F.coalesce(F.sum("amount"), F.lit(0).cast("decimal(28,2)")).alias("monetary")))
    ref = F.date_add(F.lit(base.agg(F.max("_last")).first()[0]).cast("date"), 1)
    return (base.withColumn("recency", F.datediff(ref, "_last").cast("long"))
            .filter(F.col("recency").isNotNull())
            .select(KEY, "recency", "frequency", "monetary"))


def _rank_bins(base: DataFrame, bins: int = 5) -> DataFrame:
    """``f_score`` and ``m_score``: ``qcut(rank(method='first'), 5)`` by (metric, key).

    Only the last row of each bin is needed, and it is selected without a sort
    (``operators.selection``). Customer keys that are no integers are ranked over
    range partitions instead.
    """
    if not isinstance(base.schema[KEY].dataType, T.IntegralType):
        ranked = global_row_number(global_row_number(base, ["frequency", KEY], "_f"), ["monetary", KEY], "_m")
        n = ranked.agg(F.count(F.lit(1)).alias("_n"))
        return (ranked.transform(with_row(n)).withColumn("f_score", qcut_rank_bin("_f", "_n", bins))
                .withColumn("m_score", qcut_rank_bin("_m", "_n", bins)).drop("_f", "_m", "_n"))
    for metric, score in (("frequency", "f_score"), ("monetary", "m_score")):
        edges, _ = bin_edges(base, metric, KEY, bins)
        base = base.withColumn(score, bin_of(F.col(metric), F.col(KEY), edges, base.schema[metric].dataType))
    return base


def rfm_scores(base: DataFrame) -> DataFrame:
    """Add r/f/m scores (1..5), the 3-digit code, the total and the segment.

    * R: five quantile bins of raw recency, labels reversed (low recency = 5),
      lowest edge included; coinciding edges -> first matching edge wins.
    * F, M: ``qcut(rank(method='first'))`` – rank on (metric, key).

    ``base`` is read by several jobs: it should be materialised (``rfm_base`` is).
    """
    edges = base.agg(F.percentile("recency", R_PROBS).alias("_e"))
    e = F.col("_e")
    r = (F.when(F.col("recency") <= e[0], 5).when(F.col("recency") <= e[1], 4)
         .when(F.col("recency") <= e[2], 3).when(F.col("recency") <= e[3], 2).otherwise(1))
    return (_rank_bins(base).transform(with_row(edges))  # one-row scalar
            .withColumn("r_score", r.cast("long"))
            .withColumn("rfm_score", F.concat(F.col("r_score").cast("string"),
                                              F.col("f_score").cast("string"),
                                              F.col("m_score").cast("string")))
            .withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .withColumn("segment", rfm_segment("r_score", "f_score", "m_score"))
            .select(*base.columns, "r_score", "f_score", "m_score", "rfm_score", "rfm_total", "segment"))


def rfm(orders: DataFrame, **cols) -> DataFrame:
    """Scored RFM table; monetary stays DECIMAL(28,2) for exact downstream sums."""
    return rfm_scores(rfm_base(orders, **cols))


def with_double_money(df: DataFrame, cols: Sequence[str] = ("monetary",)) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


def segment_summary(scored: DataFrame) -> DataFrame:
    """Per segment: count, mean R/F/M, revenue and shares, banker's-rounded to 2."""
    g = (scored.groupBy("segment")
         .agg(F.count(F.lit(1)).alias("customer_count"),
              F.sum("recency").alias("_r"), F.sum("frequency").alias("_f"),
              F.sum("monetary").alias("_m")))
    # the grouped table has one row per segment (ten at most): bounded
    totals = g.agg(F.sum("customer_count").alias("_tc"), F.sum("_m").alias("_tm"))
    return (g.transform(with_row(totals)).select(
        "segment", "customer_count",
        round_half_even(mean_of_sum("_r", "customer_count"), 2).alias("avg_recency"),
        round_half_even(mean_of_sum("_f", "customer_count"), 2).alias("avg_frequency"),
        round_half_even(mean_of_sum("_m", "customer_count"), 2).alias("avg_monetary"),
        round_half_even(F.col("_m").cast("double"), 2).alias("total_revenue"),
        round_half_even(F.try_divide(F.col("customer_count").cast("double"),
                                     F.col("_tc").cast("double")) * 100, 2).alias("pct_customers"),
        round_half_even(F.try_divide(F.col("_m").cast("double"),
                                     F.col("_tm").cast("double")) * 100, 2).alias("pct_revenue"),
    ))


def vip_list(scored: DataFrame, customers: DataFrame, customer_key: str,
             attrs: Sequence[str], age_col: str | None = None,
             age_edges: Sequence[float] = (), age_labels: Sequence[str] = (),
             top_n: int = 100, quantile: float = 0.95) -> DataFrame:
    """Candidates = VIP segments OR monetary >= the 95th percentile; the
    top ``top_n`` by monetary (ties by key) with customer attributes,
    an age group and a VIP tier from the RFM total."""
    q = exact_quantiles(scored, "monetary", [quantile], prefix="_q")
    cand = (scored.transform(with_row(q))  # one-row scalar
            .filter(F.col("segment").isin(VIP_SEGMENTS) | (F.col("monetary") >= F.col("_q0")))
            .drop("_q0"))
    top = top_k(cand, "monetary", KEY, top_n, rank_name="vip_rank")
    out = lookup_small(top, KEY, customers, customer_key, list(attrs))
    if age_col and age_col in out.columns:  # optional-column guard
        label, _ = cut(age_col, age_edges, age_labels)
        out = out.withColumn("age_group", label)
    return out.withColumn("vip_tier", vip_tier("rfm_total"))
