"""Labels as integers, so that aggregates over them keep fixed-width states.

``max_by`` over text needs a variable-width buffer, which Spark can only keep by
sorting. A label column is coded by its place in the sorted list of its distinct
labels (one aggregate, a few rows), aggregated as an integer, and decoded after
grouping. The order that decides which row is last is packed into one decimal: the
day first, then the row's id.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labels of a coded column; one with more is aggregated as text
MAX_LABELS = 1000


def dictionary(df: DataFrame, column: str) -> list[str] | None:
    """The distinct labels in order; None if there are more than MAX_LABELS."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(MAX_LABELS + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= MAX_LABELS else None


def encode(column: str, labels: Sequence[str]) -> Column:
    """1-based place of a label; null for null."""
    if not labels:
        return F.lit(None).cast("int")
    place = F.array_position(F.lit(list(labels)), F.col(column))
    return F.when(place > 0, place.cast("int"))


def decode(code: Column, labels: Sequence[str]) -> Column:
    return F.try_element_at(F.lit(list(labels)), code) if labels else F.lit(None).cast("string")


def packed_order(date: str, row_id: str) -> Column:
    """(date, id) as one decimal that orders alike; nulls come first."""
    day = F.coalesce(F.datediff(F.col(date), F.lit("0001-01-01").cast("date")), F.lit(-10_000_000)) + 10_000_001
    place = F.coalesce(F.col(row_id).cast("decimal(20,0)") + F.lit(Decimal(2 ** 63 + 1)), F.lit(Decimal(0)))
    return (day.cast("decimal(9,0)") * F.lit(Decimal(10 ** 20)) + place).cast("decimal(38,0)")


def last_label(column: str, labels: Sequence[str], date: str, row_id: str) -> Column:
    """The coded label of the newest row (by date, then id) that has one."""
    return F.max_by(encode(column, labels), F.when(F.col(column).isNotNull(), packed_order(date, row_id)))
