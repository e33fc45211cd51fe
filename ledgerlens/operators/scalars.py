"""One-row results attached to other rows as scalar subqueries.

``attach(df, one_row)`` adds every column of a one-row DataFrame (a global
aggregate, a quantile, a date) to each row of ``df``. It is planned as one
scalar subquery, run once and inlined as a constant, so no join
(nested-loop or otherwise) and no broadcast is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_struct(one_row: DataFrame) -> Column:
    """The single row of ``one_row`` as a struct-valued scalar subquery."""
    return one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns])).scalar()


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    s = scalar_struct(one_row)
    return df.select("*", *[s.getField(c).alias(c) for c in one_row.columns])


def with_row(one_row: DataFrame):
    """``df.transform(with_row(t))`` == ``attach(df, t)``, for method chains."""
    return lambda df: attach(df, one_row)
