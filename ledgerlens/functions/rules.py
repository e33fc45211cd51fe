"""Ordered rule tables (first matching rule wins), as CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.exprs import col_of

# RFM segment rules in evaluation order, as
# (name, R condition, F condition, M condition); ">=k" / "<=k" / "==k".
RFM_SEGMENT_RULES = [
    ("Champions", ">=4", ">=4", ">=4"),
    ("Loyal Customers", ">=4", ">=3", ">=3"),
    ("New Customers", ">=4", "<=2", "<=2"),
    ("Potential Loyalists", ">=3", ">=3", ">=3"),
    ("Big Spenders (New)", ">=3", "<=2", ">=4"),
    ("At Risk", "<=2", ">=4", ">=4"),
    ("Lost", "<=2", "<=2", "<=2"),
    ("Need Attention", "<=2", ">=3", ">=3"),
    ("About to Sleep", "==3", "<=2", "<=2"),
]
RFM_DEFAULT_SEGMENT = "Others"

# VIP tier thresholds on the RFM total, highest first.
VIP_TIERS = [(14, "Platinum"), (11, "Gold"), (8, "Silver")]
VIP_DEFAULT_TIER = "Bronze"

# Segments that always qualify as VIP candidates.
VIP_SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists"]


def _cmp(c: Column, rule: str) -> Column:
    op, k = rule[:2], int(rule[2:])
    return {">=": c >= k, "<=": c <= k, "==": c == k}[op]


def rfm_segment(r, f, m) -> Column:
    r, f, m = col_of(r), col_of(f), col_of(m)
    out = None
    for name, rc, fc, mc in RFM_SEGMENT_RULES:
        cond = _cmp(r, rc) & _cmp(f, fc) & _cmp(m, mc)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(RFM_DEFAULT_SEGMENT))


def vip_tier(total) -> Column:
    t = col_of(total)
    out = None
    for k, name in VIP_TIERS:
        out = F.when(t >= k, F.lit(name)) if out is None else out.when(t >= k, F.lit(name))
    return out.otherwise(F.lit(VIP_DEFAULT_TIER))


def two_way_label(c, members: Sequence[str], yes: str = "High", no: str = "Low") -> Column:
    """``apply(lambda x: yes if x in members else no)``: null goes to ``no``."""
    return F.when(col_of(c).isin(list(members)), F.lit(yes)).otherwise(F.lit(no))


def wheel_category(seats) -> Column:
    """2 -> '2-wheel', >= 4 -> '4-wheel', anything else (null too) -> 'Other'."""
    s = col_of(seats)
    return (F.when(s == 2, F.lit("2-wheel"))
            .when(s >= 4, F.lit("4-wheel"))
            .otherwise(F.lit("Other")))
