"""Revenue concentration: Pareto top list and the 80 % customer count."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import money, pct
from ledgerlens.operators.ranks import global_running_sum
from ledgerlens.operators.rollups import top_k
from ledgerlens.operators.selection import Extent, Place, find
from ledgerlens.session import materialize
from ledgerlens.operators.scalars import with_row

KEY = "customer_key"


def revenue_per_customer(orders: DataFrame, key: str, amount: str) -> DataFrame:
    return (orders.filter(F.col(key).isNotNull())
            .groupBy(F.col(key).alias(KEY))
            .agg(F.coalesce(F.sum(money(amount)), F.lit(0).cast("decimal(28,2)")).alias("revenue")))


def pareto_top(rev: DataFrame, top_n: int = 20) -> DataFrame:
    """Top customers by revenue with the cumulative share of all revenue.

    The running sum is only needed for the top rows, so it runs over the
    top-n result (bounded) and is divided by the grand total (one row).
    """
    total = rev.agg(F.sum("revenue").alias("_total"))
    top = top_k(rev, "revenue", KEY, top_n, rank_name="rank")
    w = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (top.transform(with_row(total))
            .withColumn("cumulative_pct", pct(F.sum("revenue").over(w), "_total"))
            .select("rank", KEY, F.col("revenue").cast("double").alias("revenue"), "cumulative_pct"))


def pareto_80(rev: DataFrame, share: float = 0.8) -> DataFrame:
    """Customers needed for ``share`` of revenue: count(cumsum <= share*total)+1.

    The place where the running sum passes the limit is selected by refined
    histograms of (count, exact sum); the order of tied revenues does not change the
    count. A running sum only falls where revenues are negative: then it is formed
    over range partitions.
    """
    rev = materialize(rev)
    part, seen = Decimal(str(share)), []

    def wanted(x: Extent) -> list[Place]:
        seen.append(x)
        return [Place(limit=x.total * part, descending=True)]
    place, = find(rev, "revenue", wanted)
    n, total, within = seen[0].n, seen[0].total, place.before
    if n and seen[0].low < 0:
        run = global_running_sum(rev, [F.col("revenue").desc(), F.col(KEY).asc()], "revenue", "_cum")
        within = run.filter(F.col("_cum") <= F.lit(total * part)).count()
    return (rev.sparkSession.createDataFrame([(n, float(total) if n else None, within + 1)],
                                             "total_customers long, total_revenue double, customers_for_share long")
            .withColumn("pct_customers_for_share", pct("customers_for_share", "total_customers")))
