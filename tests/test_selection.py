"""Order statistics by refined histograms against sorted Python lists and numpy."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import selection
from ledgerlens.operators.selection import Place, bin_edges, bin_of, find, quantiles

KINDS = {"long": "long", "money": "decimal(28,2)", "double": "double"}


@pytest.fixture(params=[(4096, 1024), (5, 8), (1, 3)], ids=["fetch", "rounds", "bins of three"])
def limits(request, monkeypatch):
    monkeypatch.setattr(selection, "FETCH", request.param[0])
    monkeypatch.setattr(selection, "BINS", request.param[1])


def _values(kind, n, seed):
    rnd = random.Random(seed)
    heavy = rnd.random() < 0.5
    out = []
    for i in range(n):
        v = 7 if heavy and rnd.random() < 0.4 else rnd.choice([rnd.randrange(20), rnd.randrange(10 ** 9)])
        out.append(Decimal(v) / 100 if kind == "money" else v / 8 if kind == "double" else v)
    return out


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("seed", range(3))
def test_ranks_with_ties_by_key(spark, limits, kind, seed):
    values = _values(kind, 300, seed)
    rows = [(v, (i * 7919) % 1000) for i, v in enumerate(values)] + [(None, 1)]
    df = spark.createDataFrame(rows, f"v {KINDS[kind]}, k long").repartition(3)
    want = sorted(r for r in rows if r[0] is not None)
    ranks = [1, 2, 60, 61, 150, 299, 300]
    found = find(df, "v", lambda x: [Place(rank=r) for r in ranks], "k")
    assert [(p.value, p.key) for p in found] == [want[r - 1] for r in ranks]


@pytest.mark.parametrize("seed", range(3))
def test_sum_of_the_greatest(spark, limits, seed):
    values = _values("money", 250, seed)
    df = spark.createDataFrame([(v,) for v in values], "v decimal(28,2)")
    ranks = [1, 25, 249, 250]
    found = find(df, "v", lambda x: [Place(rank=r, descending=True) for r in ranks])
    assert [p.total for p in found] == [sum(sorted(values, reverse=True)[:r]) for r in ranks]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("share", ["0", "0.1", "0.8", "1"])
def test_rows_within_a_limit(spark, limits, seed, share):
    values = [*_values("money", 250, seed), Decimal(0), Decimal(0)]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(28,2)")
    limit = sum(values) * Decimal(share)
    place, = find(df, "v", lambda x: [Place(limit=x.total * Decimal(share), descending=True)])
    total = within = 0
    for v in sorted(values, reverse=True):
        total += v
        within += total <= limit
    assert place.before == within


def test_quantiles_equal_numpy(spark, limits):
    rnd = random.Random(3)
    for values in ([rnd.gauss(0, 1e6) for _ in range(200)], [5.0] * 40 + [6.0], [-1.7e308, 1.7e308, 3.0, 4.0, 4.5],
                   [1e-300, 2e-300, 1.0, 1e300], [3.0]):
        df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "v double")
        probs = [0, 0.2, 0.5, 0.95, 1]
        got, want = quantiles(df, "v", probs), np.quantile(values, probs)
        assert all(a == b or math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got, want))
    assert quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]


def test_repeated_rows_and_places_outside(spark, limits):
    df = spark.createDataFrame([(1, 1)] * 30 + [(2, 5)], "v long, k long")
    found = find(df, "v", lambda x: [Place(rank=r) for r in (0, 1, 30, 31, 32)], "k")
    assert [(p.value, p.key) for p in found] == [(None, None), (1, 1), (1, 1), (2, 5), (None, None)]
    assert list(find(df.filter("v > 9"), "v", lambda x: [Place(rank=1)]))[0].value is None


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 6, 101])
def test_bins_equal_qcut_of_ranks(spark, limits, n):
    import pandas as pd
    rnd = random.Random(n)
    rows = [(rnd.randrange(4), k) for k in range(n)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "v long, k long")
    edges, total = bin_edges(df, "v", "k", 5)
    assert total == n
    got = {r.k: r.b for r in df.select("k", bin_of(F.col("v"), F.col("k"), edges, T.LongType()).alias("b")).collect()}
    if n > 1:
        s = pd.DataFrame(sorted(rows), columns=["v", "k"])
        want = pd.qcut(s["v"].rank(method="first"), 5, labels=False) + 1
        assert got == dict(zip(s["k"], want))
    else:
        assert set(got.values()) <= {1}


def test_no_row_is_moved(spark):
    """Scoring ranks no customer: neither a range exchange nor a window over all rows."""
    from ledgerlens.plans import rfm
    scored = rfm.rfm(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"))
    plan = scored._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan
