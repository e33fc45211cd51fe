"""Customer descriptive analyses: statistics, distributions, bins, crosstabs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.bins import bin_spine, cut
from ledgerlens.functions.exprs import mean_of_sum, round6
from ledgerlens.operators.ranks import exact_quantiles
from ledgerlens.operators.rollups import value_counts
from ledgerlens.operators.scalars import with_row
from ledgerlens.session import materialize


def basic_stats(cust: DataFrame, value: str, labels: Sequence[str], flag_col: str,
                flag_value: str) -> DataFrame:
    """One row: counts, distincts, min/max/mean/median/std, a conditional
    count and the modes (ties -> smallest value).

    No row is expanded: the moments are one plain aggregate, and each label's
    distinct count and mode are read off its value counts.
    """
    v = F.col(value)
    out = cust.agg(
        F.count(F.lit(1)).alias("n_customers"), F.min(v).cast("double").alias(f"min_{value}"),
        F.max(v).cast("double").alias(f"max_{value}"),
        round6(mean_of_sum(F.sum(v.cast("decimal(38,6)")), F.count(v))).alias(f"mean_{value}"),
        round6(F.stddev_samp(v)).alias(f"std_{value}"),
        F.count_if(F.col(flag_col) == F.lit(flag_value)).alias("n_flagged"))
    pieces = [cust.filter(v.isNotNull()).select(v).distinct().agg(F.count(F.lit(1)).alias(f"n_distinct_{value}"))]
    for c in labels:
        counts = materialize(value_counts(cust, c, "n"))  # read by the count and the mode
        pieces.append(counts.agg(F.count(F.lit(1)).alias(f"n_distinct_{c}")))
        pieces.append(mode(counts, c, "n").withColumnRenamed(c, f"mode_{c}"))
    pieces.append(exact_quantiles(cust, value, [0.5], prefix="_ll_med"))
    for one in pieces:
        out = out.transform(with_row(one))  # one row each
    return out.withColumn(f"median_{value}", round6("_ll_med0")).drop("_ll_med0")


def mode(counts: DataFrame, col: str, n: str) -> DataFrame:
    """The most frequent value of a value-count table, the smallest of several: one row at most."""
    return counts.orderBy(F.col(n).desc(), F.col(col).asc()).limit(1).select(col)


def binned(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    label, order = cut(value, edges, labels)
    return df.withColumn("bin_label", label).withColumn("bin_order", order)


def bin_stats(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Counts, share, mean, std per bin in bin order; empty bins kept
    (pandas categorical group-by), values outside the edges dropped."""
    b = binned(df, value, edges, labels).filter(F.col("bin_order").isNotNull())
    g = b.groupBy("bin_order").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(value).cast("decimal(38,6)")).alias("_s"),
        F.stddev_samp(value).alias("_std"))
    spine = bin_spine(df.sparkSession, labels)  # one row per label: bounded
    total = g.agg(F.sum("n").alias("_t"))
    j = (spine.join(g, "bin_order", "left").transform(with_row(total))
         .withColumn("n", F.coalesce("n", F.lit(0).cast("long"))))
    return j.select("bin_order", "bin_label", "n",
                    round6(F.try_divide(F.col("n").cast("double"), F.col("_t").cast("double")) * 100).alias("pct"),
                    round6(mean_of_sum("_s", F.when(F.col("n") > 0, F.col("n")))).alias(f"mean_{value}"),
                    round6("_std").alias(f"std_{value}"))


def label_shares(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Value counts with share of all rows and a fixed display order."""
    vc = value_counts(df, col, "n", "pct", share_of_rows=True)
    ordinal = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(col))
    return vc.withColumn("display_order", F.when(ordinal > 0, ordinal.cast("long")))
