"""Cohort retention and renewal, kept in long form (cohort, index, value).

* orders are first reduced to one row per (customer, month) with a renewal
  flag, combined map-side, so that a hot customer is at most ``months`` rows;
* the customer's first month is a window minimum over those few rows, in the
  order the aggregate already has them; cells are then counted;
* the cell tables hold at most months² rows, so everything after that is tiny.

Matrix rules kept from the reference: retention cells exist only where
someone ordered; the renewal matrix is re-indexed onto retention's cohorts
and month columns, and only cells of a cohort row or a month column that had
no renewal at all become 0 – other missing cells stay missing (omitted).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import month_index, month_start, pct, round6
from ledgerlens.session import materialize
from ledgerlens.operators.scalars import with_row

KEY = "customer_key"


def cohort_orders(orders: DataFrame, key: str, date: str, flag: str) -> DataFrame:
    """Orders with a date and a customer, as (customer, month, flag)."""
    o = orders.select(F.col(key).alias(KEY), F.to_date(date).alias("_date"), F.col(flag).alias("_flag"))
    return (o.filter(F.col("_date").isNotNull() & F.col(KEY).isNotNull())
            .select(KEY, month_start("_date").alias("_month"), "_flag"))


def cohort_cells(co: DataFrame, renewal_value: str | None = None) -> DataFrame:
    """(cohort_month, cohort_index, customers, renewals, cohort_size) in one pass.

    The cohort size (the index-1 cell) comes from a window over the cell
    table, which has at most months^2 rows.
    """
    # label match under the UNICODE collation: composed and decomposed
    # spellings of the same label (e.g. NFC vs NFD Vietnamese) are equal
    renewed = ((F.collate(F.col("_flag"), "UNICODE") == F.lit(renewal_value))
               if renewal_value is not None else F.lit(False))
    per_month = co.groupBy(KEY, "_month").agg(F.max(F.coalesce(renewed, F.lit(False))).alias("_renewed"))
    first = F.min("_month").over(Window.partitionBy(KEY))  # months rows per customer at most
    cells = (per_month.withColumn("_first", first)
             .groupBy(F.date_format("_first", "yyyy-MM").alias("cohort_month"),
                      month_index("_month", "_first").cast("long").alias("cohort_index"))
             .agg(F.count(F.lit(1)).alias("customers"), F.count_if("_renewed").alias("renewals")))
    w = Window.partitionBy("cohort_month")
    # at most months^2 rows, read several times (grid, sizes, rates): checkpoint
    return materialize(cells.withColumn(
        "cohort_size", F.max(F.when(F.col("cohort_index") == 1, F.col("customers"))).over(w)))


def retention(co: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """(cohort_month, cohort_index, customers, cohort_size, retention_pct)."""
    c = cells if cells is not None else cohort_cells(co)
    return c.select("cohort_month", "cohort_index", "customers", "cohort_size",
                    pct("customers", "cohort_size").alias("retention_pct"))


def renewal(co: DataFrame, renewal_value: str, cells: DataFrame | None = None) -> DataFrame:
    """(cohort_month, cohort_index, renewals, cohort_size, renewal_pct) on
    retention's grid, with the reference's zero-versus-missing rule."""
    c = cells if cells is not None else cohort_cells(co, renewal_value)
    ren = c.filter(F.col("renewals") > 0)
    sizes = c.select("cohort_month", "cohort_size").distinct()
    # grid = retention cohorts x retention month columns; both lists are
    # bounded by the number of months, the index list travels as one array
    idx = c.agg(F.array_sort(F.collect_set("cohort_index")).alias("_idx"))
    grid = (sizes.transform(with_row(idx))
            .select("cohort_month", "cohort_size", F.explode("_idx").alias("cohort_index")))
    ren_rows = ren.select("cohort_month").distinct().withColumn("_row_seen", F.lit(True))
    ren_cols = ren.select("cohort_index").distinct().withColumn("_col_seen", F.lit(True))
    g = (grid.join(ren.select("cohort_month", "cohort_index", "renewals"),
                   ["cohort_month", "cohort_index"], "left")
         .join(ren_rows, "cohort_month", "left")
         .join(ren_cols, "cohort_index", "left"))
    filled = F.when(F.col("renewals").isNotNull(), F.col("renewals")).when(
        F.col("_row_seen").isNull() | F.col("_col_seen").isNull(), F.lit(0).cast("long"))
    return (g.withColumn("renewals", filled)
            .filter(F.col("renewals").isNotNull())
            .select("cohort_month", "cohort_index", "renewals", "cohort_size",
                    pct("renewals", "cohort_size").alias("renewal_pct")))


def matrix_corner(cells: DataFrame, value: str, n_cohorts: int = 10,
                  indices: Sequence[int] = tuple(range(1, 13)), prefix: str = "m") -> DataFrame:
    """Pivot long cells into the first ``n_cohorts`` cohorts x ``indices``
    (explicit pivot values, so no extra job discovers them)."""
    first = (cells.select("cohort_month").distinct()
             .orderBy("cohort_month").limit(n_cohorts))
    sub = cells.join(F.broadcast(first), "cohort_month")  # bounded by n_cohorts
    wide = (sub.groupBy("cohort_month").pivot("cohort_index", list(indices))
            .agg(F.first(value)))
    return wide.select("cohort_month", *[F.col(str(i)).alias(f"{prefix}{i}") for i in indices])


def rate_means(ret: DataFrame, ren: DataFrame) -> DataFrame:
    """Mean retention at month index 2, mean renewal at index 2 and 13
    (missing cells skipped)."""
    def rate(index: int, part: str):  # not yet rounded
        share = F.try_divide(F.col(part).cast("double"), F.col("cohort_size").cast("double")) * 100
        return round6(F.avg(F.when(F.col("cohort_index") == index, share)))

    r = ret.agg(rate(2, "customers").alias("avg_retention_idx2"))
    n = ren.agg(rate(2, "renewals").alias("avg_renewal_idx2"), rate(13, "renewals").alias("avg_renewal_idx13"))
    return r.transform(with_row(n))  # one row each
