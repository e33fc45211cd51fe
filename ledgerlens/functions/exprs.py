"""Scalar column helpers reproducing pandas-style null and rounding semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "money", "safe_div", "pct", "round_half_even", "round6",
    "coerce_number", "coerce_date", "first_word", "last_dash_word",
    "starts_with_safe", "contains_safe", "truncate", "month_start",
    "month_index", "date_or_na", "int_div", "ceil_div", "qcut_rank_bin", "mean_of_sum",
]

MONEY = "decimal(18,2)"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Money as DECIMAL(18,2) so sums do not depend on summation order."""
    return col_of(c).cast(MONEY)


def safe_div(num, den) -> Column:
    """x / y with y = 0 or null -> null (ANSI mode would raise)."""
    return F.try_divide(col_of(num), col_of(den))


def pct(num, den, digits: int | None = 6) -> Column:
    """100 * num / den as a double, rounded so results repeat across engines."""
    v = F.try_divide(col_of(num).cast("double"), col_of(den).cast("double")) * F.lit(100.0)
    return F.round(v, digits) if digits is not None else v


def mean_of_sum(total, n) -> Column:
    """Mean as double(sum) / n: one IEEE division of exact inputs."""
    return F.try_divide(col_of(total).cast("double"), col_of(n).cast("double"))


def round_half_even(c, digits: int = 0) -> Column:
    """pandas/numpy ``round``: banker's rounding."""
    return F.bround(col_of(c), digits)


def round6(c) -> Column:
    return F.round(col_of(c).cast("double"), 6)


def coerce_number(c, dtype: str = MONEY, fill=0) -> Column:
    """``pd.to_numeric(errors='coerce')`` then ``fillna(fill)``."""
    v = col_of(c).try_cast(dtype)
    return F.coalesce(v, F.lit(fill).cast(dtype)) if fill is not None else v


def coerce_date(c, fmt: str | None = None) -> Column:
    """``pd.to_datetime(errors='coerce')`` for text in ISO-like layouts -> DATE."""
    c = F.trim(col_of(c).cast("string"))
    if fmt:
        return F.to_date(F.try_to_timestamp(c, F.lit(fmt)))
    return F.to_date(F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(c, F.lit("yyyy/MM/dd")),
    ))


def first_word(c) -> Column:
    """``str.extract(r'(\\w+)')`` with Unicode word characters; no match -> null."""
    return F.nullif(F.regexp_extract(col_of(c), r"(?U)(\w+)", 1), F.lit(""))


def last_dash_word(c) -> Column:
    """``str.extract(r'-(\\w+)$')``: the word after the last dash at the end."""
    return F.nullif(F.regexp_extract(col_of(c), r"(?U)-(\w+)$", 1), F.lit(""))


def starts_with_safe(c, prefix: str) -> Column:
    """``str.startswith(prefix, na=False)``."""
    return F.coalesce(F.startswith(col_of(c), F.lit(prefix)), F.lit(False))


def contains_safe(c, needle: str) -> Column:
    """``str.contains(needle, na=False)`` for a literal needle."""
    return F.coalesce(F.contains(col_of(c), F.lit(needle)), F.lit(False))


def truncate(c, n: int) -> Column:
    return F.substring(col_of(c), 1, n)


def month_start(c) -> Column:
    """``to_period('M')`` as the first day of the month (DATE)."""
    return F.trunc(F.to_date(col_of(c)), "month")


def month_index(later, first) -> Column:
    """(y2 - y1) * 12 + (m2 - m1) + 1."""
    later, first = col_of(later), col_of(first)
    return ((F.year(later) - F.year(first)) * 12
            + (F.month(later) - F.month(first)) + 1)


def date_or_na(c) -> Column:
    """``strftime('%Y-%m-%d')`` or 'N/A' when missing."""
    return F.coalesce(F.date_format(col_of(c), "yyyy-MM-dd"), F.lit("N/A"))


def int_div(a, b) -> Column:
    """Exact integer division (SQL ``a div b``)."""
    return F.call_function("div", col_of(a).cast("long"), col_of(b).cast("long"))


def ceil_div(a, b) -> Column:
    """ceil(a / b) for a >= 0, b > 0, exact integer arithmetic."""
    a, b = col_of(a).cast("long"), col_of(b).cast("long")
    return int_div(a + b - 1, b)


def qcut_rank_bin(rank, n, bins: int = 5) -> Column:
    """Bin of ``qcut(rank(method='first'), bins)`` for ranks 1..n, exactly.

    Edges of ranks 1..n sit at 1 + (n-1)*i/bins; rank r falls in the first
    bin i with r <= edge_i, i.e. max(1, ceil(bins*(r-1)/(n-1))).
    A single row has coinciding edges; it is put in bin 1.
    """
    r, n = col_of(rank).cast("long"), col_of(n).cast("long")
    b = F.greatest(F.lit(1).cast("long"), ceil_div((r - 1) * bins, n - 1))
    return F.when(n <= 1, F.lit(1).cast("long")).otherwise(b)
