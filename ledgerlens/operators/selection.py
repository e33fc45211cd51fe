"""Exact order statistics without a sort: histograms refined around the wanted places.

Given places in the order of ``(value, key)`` – a rank, or where a running sum passes
a limit – the rows that stand there are found in rounds. A round bins the values
that are still in question between their least and greatest, in one scan with a
map-side combined aggregate, and yields per bin the count, the exact sum and the
least and greatest value; only the bin that holds a place is looked at again. When
at most ``FETCH`` rows are left, they are fetched and the place is read off; when a
single value is left that more rows share, the rounds go on over the keys of those
rows. Nothing is shuffled but bins, no row is moved, and a hot value costs no more
than another.

Bins are cut by ``(value - least) / (greatest - least)``, which does not fall as the
value grows; the least value is always in the first bin and the greatest in the
last, so every round parts the rest. Values may be integers, decimals or doubles
(NaN counts as missing, like null); keys must be integers, and are needed only
where rows of one value have to be told apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: bins of a round for each place, rows fetched at the end for each place
BINS, FETCH = 1024, 4096
_V, _K = "_ll_value", "_ll_key"
_SUM = "decimal(38,6)"


@dataclass
class Place:
    """A wanted place and what has been found of it.

    ``rank`` counts from 1 in ascending order (``descending``: from the greatest).
    ``limit`` instead of it asks for the longest beginning whose values add up to at
    most ``limit``; values must not be negative then.
    """

    rank: int | None = None
    limit: Decimal | None = None
    descending: bool = False
    value: Any = None          # the row at the place (limit: the last row within it)
    key: int | None = None
    before: int = 0            # rows certainly before the place
    total: Decimal = Decimal(0)  # their sum
    low: Any = None
    high: Any = None
    n: int = 0
    fixed: Any = None          # the value whose keys are searched
    done: bool = field(default=False)

    def reached(self, n: int, total: Decimal) -> bool:
        """Whether ``n`` more rows adding ``total`` pass the place."""
        if self.rank is not None:
            return self.before + n >= self.rank
        return self.total + total > self.limit


def _prepared(df: DataFrame, value: str, key: str | None) -> tuple[DataFrame, bool]:
    """Rows with a value, as (value, key), and whether values are doubles."""
    floating = isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))
    v = F.col(value).cast("double") if floating else F.col(value)
    present = v.isNotNull() & ~F.isnan(v) if floating else v.isNotNull()
    return df.select(v.alias(_V), (F.col(key) if key else F.lit(0)).cast("long").alias(_K)).filter(present), floating


def _literal(x: Any, like: T.DataType) -> Column:
    return F.lit(x).cast(like)


def _bin(x: Column, low: Any, high: Any, dtype: T.DataType) -> Column:
    low_c, high_c = _literal(low, dtype), _literal(high, dtype)
    if isinstance(dtype, T.DoubleType):  # halves of a finite range, so that differences stay finite
        def part(c: Column) -> Column:
            return F.greatest(F.least(c, F.lit(1.7e308)), F.lit(-1.7e308)) / 4
    else:
        def part(c: Column) -> Column:
            return c.cast("decimal(38,6)") if isinstance(dtype, T.DecimalType) else c.cast("decimal(38,0)")
    share = F.try_divide((part(x) - part(low_c)).cast("double"), (part(high_c) - part(low_c)).cast("double"))
    middle = F.least(F.floor(share * BINS).cast("int"), F.lit(BINS - 1))
    return F.when(x == low_c, 0).when(x == high_c, BINS - 1).otherwise(F.coalesce(middle, F.lit(BINS // 2)))


def _inside(p: Place, dtype: T.DataType) -> Column:
    if p.fixed is not None:
        return (F.col(_V) == _literal(p.fixed, dtype)) & F.col(_K).between(p.low, p.high)
    return F.col(_V).between(_literal(p.low, dtype), _literal(p.high, dtype))


def _total(x: Any) -> Decimal:
    return Decimal(0) if x is None else x if isinstance(x, Decimal) else Decimal(str(x))


def _advance(p: Place, bins: list, stage_key: bool) -> None:
    """Go past the bins before the place and into the one that holds it."""
    for _, n, total, least, greatest in (reversed(bins) if p.descending and not stage_key else bins):
        total = _total(total)
        if not p.reached(n, total):
            p.before, p.total = p.before + n, p.total + total
            continue
        p.low, p.high, p.n = least, greatest, n
        return
    p.done = True  # the place lies behind all rows


def _settle(p: Place, rows: list[tuple[Any, int]]) -> None:
    """Read the place off the rows of its interval."""
    p.done = True
    for value, key in sorted(rows, key=lambda r: (-r[0] if p.descending else r[0], r[1])):
        if p.rank is None and p.total + _total(value) > p.limit:
            return
        p.before, p.total, p.value, p.key = p.before + 1, p.total + _total(value), value, key
        if p.rank is not None and p.before == p.rank:
            return


def _same_value(p: Place, needs_key: bool) -> bool:
    """Places that a single value settles, whatever the order of its rows."""
    if p.rank is not None and needs_key:
        return False
    if p.rank is not None:
        take = p.rank - p.before
    else:
        take = p.n if p.low == 0 else min(p.n, int((p.limit - p.total) // _total(p.low)))
    p.value, p.done = (p.low if take else p.value), True
    p.before, p.total = p.before + take, p.total + take * _total(p.low)
    return True


@dataclass(frozen=True)
class Extent:
    """What the first scan tells: rows with a value, least and greatest value, sum (0 for doubles)."""

    n: int
    low: Any
    high: Any
    total: Decimal


def find(df: DataFrame, value: str, wanted: Callable[[Extent], Sequence[Place]], key: str | None = None) -> Sequence[Place]:
    """Find the places that ``wanted`` asks for once the extent is known.

    A rank beyond the rows, and a limit below the first value, leave ``value`` None.
    """
    rows, floating = _prepared(df, value, key)
    dtype = rows.schema[_V].dataType
    total_of = F.sum(F.col(_V).cast(_SUM)) if not floating else F.lit(None).cast(_SUM)
    n, low, high, total = rows.agg(F.count(F.lit(1)), F.min(_V), F.max(_V), total_of if not floating else F.lit(None)).first()
    places = wanted(Extent(n, low, high, _total(total)))
    for p in places:
        p.low, p.high, p.n = low, high, n
        p.done = n == 0 or (p.rank is not None and not 1 <= p.rank <= n)
    while True:
        todo = [p for p in places if not p.done]
        for p in todo:  # a single value is left: settle it, or search its keys
            if p.fixed is not None and p.low is not None and p.low == p.high:
                p.value, p.key, p.done = p.fixed, p.low, True  # rows that repeat value and key
            elif p.fixed is None and p.low == p.high and not _same_value(p, key is not None):
                p.fixed, p.low, p.high = p.low, None, None
        todo = [p for p in todo if not p.done]
        if not todo:
            return places
        few = [p for p in todo if p.n <= FETCH]
        if few and len(few) == len(todo):
            _fetch(rows, few, dtype)
            continue
        open_ = [p for p in todo if p.n > FETCH]
        keyed = [p for p in open_ if p.fixed is not None and p.low is None]
        if keyed:  # the range of the keys of one value
            _key_ranges(rows, keyed, dtype)
        _round(rows, open_, dtype, total_of)


def _distinct_intervals(places: Sequence[Place]) -> dict[tuple, list[Place]]:
    out: dict[tuple, list[Place]] = {}
    for p in places:
        out.setdefault((p.fixed, p.low, p.high), []).append(p)
    return out


def _tagged(rows: DataFrame, groups: Sequence[Place], dtype: T.DataType, tag) -> DataFrame:
    """Every row once for each interval it lies in (intervals are few)."""
    tags = F.array(*[F.when(_inside(p, dtype), tag(i, p)) for i, p in enumerate(groups)])
    return rows.withColumn("_ll_in", F.explode(F.array_compact(tags)))


def _round(rows: DataFrame, places: Sequence[Place], dtype: T.DataType, total_of: Column) -> None:
    groups = list(_distinct_intervals(places).values())

    def tag(i: int, p: Place) -> Column:
        at = _bin(F.col(_K), p.low, p.high, T.LongType()) if p.fixed is not None else _bin(F.col(_V), p.low, p.high, dtype)
        return F.struct(F.lit(i).alias("i"), at.cast("int").alias("bin"))
    found = (_tagged(rows, [g[0] for g in groups], dtype, tag).groupBy("_ll_in.i", "_ll_in.bin")
             .agg(F.count(F.lit(1)), total_of, F.min(_V), F.max(_V), F.min(_K), F.max(_K)).collect())
    for i, group in enumerate(groups):
        stage_key = group[0].fixed is not None
        bins = sorted((r[1], r[2], r[3], *((r[6], r[7]) if stage_key else (r[4], r[5]))) for r in found if r[0] == i)
        for p in group:
            _advance(p, bins, stage_key)


def _key_ranges(rows: DataFrame, places: Sequence[Place], dtype: T.DataType) -> None:
    ends = rows.filter(F.col(_V).isin([_literal(p.fixed, dtype) for p in places])).groupBy(_V).agg(F.min(_K), F.max(_K)).collect()
    for p in places:
        p.low, p.high = next((r[1], r[2]) for r in ends if r[0] == p.fixed)


def _fetch(rows: DataFrame, places: Sequence[Place], dtype: T.DataType) -> None:
    for p in places:
        if p.fixed is not None and p.low is None:
            p.low, p.high = -(1 << 63), (1 << 63) - 1
    groups = list(_distinct_intervals(places).values())
    found = _tagged(rows, [g[0] for g in groups], dtype, lambda i, p: F.lit(i)).select("_ll_in", _V, _K).collect()
    for i, group in enumerate(groups):
        held = [(r[1], r[2]) for r in found if r[0] == i]
        for p in group:
            _settle(p, held)


def quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> list[float | None]:
    """Exact linear-interpolated quantiles; None without values."""
    def at(n: int) -> list[Decimal]:
        return [(n - 1) * Decimal(str(p)) for p in probs]

    rows = []

    def wanted(x: Extent) -> list[Place]:
        rows.append(x.n)
        return [Place(rank=r) for r in sorted({r for h in at(x.n) for r in (int(h) + 1, min(x.n, int(h) + 2))})] if x.n else []
    found = {p.rank: float(p.value) for p in find(df, value, wanted)}
    if not found:
        return [None] * len(probs)
    out = []
    for h in at(rows[0]):
        lo, part = found[int(h) + 1], h - int(h)
        out.append(lo + (found[int(h) + 2] - lo) * float(part) if part else lo)
    return out


def bin_edges(df: DataFrame, value: str, key: str, bins: int) -> tuple[list[tuple[Any, int]], int]:
    """The last (value, key) of every bin but the last of ``qcut(rank(method='first'), bins)``,
    ranked by (value, key), and the number of rows."""
    rows = []

    def wanted(x: Extent) -> list[Place]:
        rows.append(x.n)
        return [Place(rank=i * (x.n - 1) // bins + 1) for i in range(1, bins)] if x.n > 1 else []
    return [(p.value, p.key) for p in find(df, value, wanted, key)], rows[0]


def bin_of(value: Column, key: Column, edges: Sequence[tuple[Any, int]], dtype: T.DataType) -> Column:
    """1-based bin of a row: one more than the number of edges it lies behind."""
    out = F.lit(1).cast("long")
    for v, k in edges:
        edge = _literal(v, dtype)
        out = out + ((value > edge) | ((value == edge) & (key > F.lit(k)))).cast("long")
    return out
