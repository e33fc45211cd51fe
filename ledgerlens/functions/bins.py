"""Fixed-edge binning with ``pandas.cut`` semantics.

Bins are right-closed ``(lo, hi]``; the lowest edge is excluded and values
outside every bin (or null) get a null label. Each bin also carries its
1-based ordinal so "key order" sorts follow the edges, not the label text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.exprs import col_of


def _check(edges: Sequence[float], labels: Sequence[str]) -> None:
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must increase strictly")


def cut(c, edges: Sequence[float], labels: Sequence[str]) -> tuple[Column, Column]:
    """Return (label, ordinal) columns for value ``c``."""
    _check(edges, labels)
    x = col_of(c)
    label = None
    ordinal = None
    for i, (lo, hi, lab) in enumerate(zip(edges, edges[1:], labels), start=1):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
        ordinal = F.when(cond, F.lit(i)) if ordinal is None else ordinal.when(cond, F.lit(i))
    return label, ordinal


def bin_spine(spark: SparkSession, labels: Sequence[str],
              label_col: str = "bin_label", ordinal_col: str = "bin_order") -> DataFrame:
    """All bins as a tiny DataFrame (bounded by the label list), for keeping
    empty categories like pandas' categorical group-by does."""
    schema = T.StructType([
        T.StructField(ordinal_col, T.IntegerType(), False),
        T.StructField(label_col, T.StringType(), False),
    ])
    return spark.createDataFrame([(i, lab) for i, lab in enumerate(labels, 1)], schema)
