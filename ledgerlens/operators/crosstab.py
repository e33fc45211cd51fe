"""Crosstabs in long form: (row, col, count) with pandas' zero filling.

The zero-filled grid is rows x columns of the *label* sets (a crosstab's
output size, bounded by the two label cardinalities, never by the data);
the column labels travel as one array and are exploded per row. The count
table is checkpointed because the grid and the join both read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import pct
from ledgerlens.session import materialize
from ledgerlens.operators.scalars import with_row

ALL = "All"
#: labels of the column side that one array may hold; more is an error
MAX_LABELS = 10_000


def _grid(counts: DataFrame, row: str, col: str) -> DataFrame:
    if counts.select(col).distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"{col} has more than {MAX_LABELS} labels; put it on the row side or bin it")
    cols = counts.agg(F.array_sort(F.collect_set(col)).alias("_cols"))
    rows = counts.select(row).distinct()
    return (rows.transform(with_row(cols))  # one-row array of labels
            .select(row, F.explode("_cols").alias(col)))


def crosstab_counts(df: DataFrame, row: str, col: str, name: str = "n") -> DataFrame:
    """``pd.crosstab(row, col)``: rows with a null in either column are dropped,
    every (row label, col label) pair is present, absent pairs count 0."""
    counts = materialize(df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
                         .groupBy(row, col).agg(F.count(F.lit(1)).alias(name)))
    return (_grid(counts, row, col).join(counts, [row, col], "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long"))))


def crosstab_row_pct(df: DataFrame, row: str, col: str, name: str = "pct") -> DataFrame:
    """``pd.crosstab(row, col, normalize='index') * 100`` in long form."""
    counts = crosstab_counts(df, row, col, "_n")
    w = Window.partitionBy(row)
    return (counts.withColumn("_row_total", F.sum("_n").over(w))
            .select(row, col, pct("_n", "_row_total").alias(name)))


def crosstab_margins(df: DataFrame, row: str, col: str, name: str = "n") -> DataFrame:
    """``pd.crosstab(row, col, margins=True)``: adds the 'All' row and column.

    ``cube`` computes the cells and all three margins in one aggregate.
    """
    clean = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    cubed = (clean.cube(row, col).agg(F.count(F.lit(1)).alias(name),
                                      F.grouping(row).alias("_gr"), F.grouping(col).alias("_gc"))
             .select(F.when(F.col("_gr") == 1, F.lit(ALL)).otherwise(F.col(row).cast("string")).alias(row),
                     F.when(F.col("_gc") == 1, F.lit(ALL)).otherwise(F.col(col).cast("string")).alias(col),
                     name))
    cubed = materialize(cubed)  # read by the grid and the join
    return (_grid(cubed, row, col).join(cubed, [row, col], "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long"))))
