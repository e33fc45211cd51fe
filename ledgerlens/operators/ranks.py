"""Operators that need a total order over all rows, spread over partitions.

An un-partitioned window (``Window.orderBy``) moves every row into one task.
Instead rows are range-partitioned on the full sort key (the key always ends
in a unique column, so one hot value is split across partitions), sorted
inside each partition and tagged with their position there; the tagged data
is checkpointed so the range bounds cannot change between the two uses.
Per-partition counts (or sums) are then turned into offsets over a table
with one row per partition, and each row adds its partition's offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialize
from ledgerlens.operators.selection import quantiles

_PID, _POS, _OFF = "_ll_pid", "_ll_pos", "_ll_off"
_LOCAL_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in the low 33 bits


def _sort_cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _tag_positions(df: DataFrame, order: Sequence, num_partitions: int | None) -> DataFrame:
    cols = _sort_cols(order)
    parts = (df.repartitionByRange(num_partitions, *cols) if num_partitions
             else df.repartitionByRange(*cols))
    tagged = (parts.sortWithinPartitions(*cols)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS))))
    return materialize(tagged)


def _offsets(tagged: DataFrame, value: Column, name: str) -> DataFrame:
    per_part = tagged.groupBy(_PID).agg(value.alias(name))
    # One row per partition: a single-task window here is bounded by the
    # partition count, not by the data.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(_PID, F.coalesce(F.sum(name).over(w), F.lit(0)).alias(_OFF))


def global_row_number(df: DataFrame, order: Sequence, name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by <order>)`` without an unbounded single task.

    ``order`` must end in a unique column so the numbering is deterministic.
    """
    tagged = _tag_positions(df, order, num_partitions)
    offs = _offsets(tagged, F.count(F.lit(1)), "_ll_n")
    # offs has one row per partition: a proven bound for broadcasting.
    return (tagged.join(F.broadcast(offs), _PID)
            .withColumn(name, (F.col(_OFF) + F.col(_POS) + 1).cast("long"))
            .drop(_PID, _POS, _OFF))


def global_running_sum(df: DataFrame, order: Sequence, value: str, name: str = "running",
                       num_partitions: int | None = None) -> DataFrame:
    """``sum(value) over (order by <order> rows unbounded preceding)``."""
    tagged = _tag_positions(df, order, num_partitions)
    offs = _offsets(tagged, F.sum(value), "_ll_s")
    w = (Window.partitionBy(_PID).orderBy(_POS)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (tagged.join(F.broadcast(offs), _PID)
            .withColumn(name, F.col(_OFF) + F.sum(value).over(w))
            .drop(_PID, _POS, _OFF))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], prefix: str = "q",
                    groups: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / ``percentile`` semantics), always double.

    Without groups the values are selected (``operators.selection``): no row is moved.
    With groups values are counted first (map-side combined), so a hot value is one row;
    the running count over the distinct values is spread over range partitions
    at every size, and each wanted rank lies in the value whose running count
    covers it. Returns one row per group with columns ``{prefix}0``, ``{prefix}1``, ...
    """
    groups = list(groups)
    if not groups:
        return df.sparkSession.createDataFrame(
            [tuple(quantiles(df, value, probs))], ", ".join(f"{prefix}{i} double" for i in range(len(probs))))
    v, n, cum = F.col("_ll_v"), F.col("_ll_n"), F.col("_ll_cum")
    counted = (df.select(*groups, F.col(value).cast("double").alias("_ll_v")).filter(v.isNotNull())
               .groupBy(*groups, "_ll_v").agg(F.count(F.lit(1)).alias("_ll_n")))
    run = global_running_sum(counted, groups + ["_ll_v"], "_ll_n", "_ll_cum")
    sizes = (F.min(cum - n).alias("_ll_start"), F.sum(n).alias("_ll_cnt"))
    run = run.join(run.groupBy(*groups).agg(*sizes), groups)
    picks, out = [], []
    for i, p in enumerate(probs):
        h = (F.col("_ll_cnt") - 1).cast("decimal(20,0)") * F.lit(str(p)).cast("decimal(10,9)")
        for side, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            rank = F.col("_ll_start") + at.cast("long") + 1
            picks.append(F.max(F.when((cum - n < rank) & (rank <= cum), v)).alias(f"_ll_{side}{i}"))
        picks.append(F.max((h - F.floor(h)).cast("double")).alias(f"_ll_part{i}"))
        out.append((F.col(f"_ll_lo{i}") + (F.col(f"_ll_hi{i}") - F.col(f"_ll_lo{i}"))
                    * F.col(f"_ll_part{i}")).alias(f"{prefix}{i}"))
    return run.groupBy(*groups).agg(*picks).select(*groups, *out)
