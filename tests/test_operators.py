"""Operators against brute-force / pandas references on small fixtures."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import crosstab as xt
from ledgerlens.operators import profile as prof
from ledgerlens.operators.lookup import lookup
from ledgerlens.operators.ranks import exact_quantiles, global_row_number, global_running_sum
from ledgerlens.operators.rollups import bottom_k, top_k, value_counts
from ledgerlens.plans.customer_value import last_non_null


@pytest.mark.parametrize("seed,n,parts", [(1, 50, 3), (2, 500, 7), (3, 1000, 16)])
def test_global_row_number_equals_single_window(spark, seed, n, parts):
    rnd = random.Random(seed)
    data = [(i, rnd.randint(1, 5)) for i in range(n)]  # heavy ties on the metric
    df = spark.createDataFrame(data, "k long, v long").repartition(parts)
    got = {r.k: r.rn for r in global_row_number(df, ["v", "k"], "rn", num_partitions=parts).collect()}
    w = Window.orderBy("v", "k")
    exp = {r.k: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == exp


def test_global_running_sum_desc(spark):
    rnd = random.Random(7)
    data = [(i, rnd.randint(0, 20)) for i in range(300)]
    df = spark.createDataFrame(data, "k long, v long")
    got = {r.k: r.c for r in global_running_sum(df, [F.col("v").desc(), F.col("k")], "v", "c",
                                                 num_partitions=5).collect()}
    pdf = pd.DataFrame(data, columns=["k", "v"]).sort_values(["v", "k"], ascending=[False, True])
    pdf["c"] = pdf["v"].cumsum()
    assert got == dict(zip(pdf.k, pdf.c))


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1001])
def test_exact_quantiles_match_numpy(spark, n):
    rnd = random.Random(n)
    vals = [rnd.randint(0, 50) for _ in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v long")
    probs = [0.2, 0.5, 0.95]
    row = exact_quantiles(df, "v", probs).first()
    for i, p in enumerate(probs):
        assert float(row[f"q{i}"]) == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)


def test_value_counts_drop_null_and_shares(spark):
    # share_nulls: normalize=True excludes null; count/len includes null rows
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    norm = {r.x: r.pct for r in value_counts(df, "x", "n", "pct").collect()}
    rows_ = {r.x: r.pct for r in value_counts(df, "x", "n", "pct", share_of_rows=True).collect()}
    assert norm == {"a": pytest.approx(66.666667), "b": pytest.approx(33.333333)}
    assert rows_ == {"a": 50.0, "b": 25.0}


def test_top_and_bottom_k_ties_by_key(spark):
    # pareto_ties: equal metrics ordered by key
    df = spark.createDataFrame([(3, 10.0), (1, 10.0), (2, 5.0), (4, 1.0), (5, 1.0)], "k long, v double")
    assert [r.k for r in top_k(df, "v", "k", 3).orderBy("rank").collect()] == [1, 3, 2]
    # tail of the descending order (v desc, k asc) = ... 2, 4, 5 ; rank 1 = last
    assert [(r.k, r["rank"]) for r in bottom_k(df, "v", "k", 2).orderBy("rank").collect()] == [(5, 1), (4, 2)]


def test_crosstab_zero_fill_and_margins(spark):
    df = spark.createDataFrame([("r1", "x"), ("r1", "y"), ("r2", "x"), (None, "x"), ("r2", None)],
                               "r string, c string")
    counts = {(a.r, a.c): a.n for a in xt.crosstab_counts(df, "r", "c").collect()}
    assert counts == {("r1", "x"): 1, ("r1", "y"): 1, ("r2", "x"): 1, ("r2", "y"): 0}
    m = {(a.r, a.c): a.n for a in xt.crosstab_margins(df, "r", "c").collect()}
    exp = pd.crosstab(pd.Series(["r1", "r1", "r2"], name="r"), pd.Series(["x", "y", "x"], name="c"),
                      margins=True)
    for r in exp.index:
        for c in exp.columns:
            assert m[(r, c)] == exp.loc[r, c]
    pctab = {(a.r, a.c): a.pct for a in xt.crosstab_row_pct(df, "r", "c").collect()}
    assert pctab[("r1", "x")] == 50.0 and pctab[("r2", "y")] == 0.0


def test_null_and_duplicate_counts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "a"), (3, "b")],
                               "k int, s string")
    assert prof.duplicate_rows(df).first()[0] == 3  # null = null, like pandas duplicated()
    nulls = {r.column_name: r.n_null for r in prof.null_counts(df).collect()}
    assert nulls == {"k": 0, "s": 2}
    issues = prof.quality_issues({"t": df}).collect()
    assert {(r.issue, r.column_name, r.n) for r in issues} == {("missing", "s", 2),
                                                             ("duplicate_rows", None, 3)}


def test_orphan_keys_counts_distinct_keys_and_nulls(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (2,)], "p long")
    r = prof.orphan_keys("c->p", child, "k", parent, "p").first()
    assert (r.n_child_keys, r.n_orphan_keys, r.n_null_keys) == (2, 1, 1)


def test_lookup_dedups_dimension(spark):
    # dim_dupes: duplicate key never fans out; missing key gets the default
    fact = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, name string")
    got = {r.k: r.name for r in lookup(fact, "k", dim, "k", ["name"], default={"name": "Unknown"}).collect()}
    assert got == {1: "a", 2: "c", 3: "Unknown"}


def test_last_non_null(spark):
    # last_null: newest row of a customer has a null company
    df = spark.createDataFrame([(1, "2024-01-01", "A"), (1, "2024-03-01", None), (1, "2024-02-01", "B"),
                                (2, "2024-01-01", None)], "c long, d string, v string")
    got = {r.c: r.v for r in df.groupBy("c").agg(last_non_null("v", "d").alias("v")).collect()}
    assert got == {1: "B", 2: None}


def test_exact_quantiles_of_decimals_are_double_and_hot_values_one_row(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7)
                                  .cast("decimal(18,2)").alias("v"))
    got = exact_quantiles(df, "v", [0.5, 0.95])
    assert [t for _, t in got.dtypes] == ["double", "double"]
    vals = [float(r.v) for r in df.collect()]
    assert list(got.first()) == [pytest.approx(float(np.quantile(vals, p)), abs=1e-9) for p in (0.5, 0.95)]


@pytest.mark.parametrize("seed", [10000, 20])
def test_exact_quantiles_grouped_with_ties(spark, seed):
    rnd = random.Random(seed)
    data = [(g, i, rnd.choice([1.0, 2.0, 2.0, 3.5, float(rnd.randint(0, 400))]))
            for g in range(4) for i in range(rnd.randint(1, 400))]
    df = spark.createDataFrame(data, "g long, k long, v double")
    probs = [0.25, 0.5, 0.95]
    got = {r.g: r for r in exact_quantiles(df, "v", probs, groups=["g"]).collect()}
    pdf = pd.DataFrame(data, columns=["g", "k", "v"])
    for g, part in pdf.groupby("g"):
        for i, p in enumerate(probs):
            assert float(got[g][f"q{i}"]) == pytest.approx(float(part.v.quantile(p)), abs=1e-9)


def test_orphan_keys_compare_in_their_own_types(spark):
    child = spark.createDataFrame([(1.0,), (9.0,), (None,)], "a double")
    parent = spark.createDataFrame([(1,), (2,)], "p long")
    r = prof.orphan_keys("a", child, "a", parent, "p").first()
    assert (r.n_child_keys, r.n_orphan_keys, r.n_null_keys) == (2, 1, 1)
    none = prof.orphan_keys("a", child.limit(0), "a", parent, "p").collect()
    assert [tuple(x) for x in none] == [("a", 0, 0, 0)]


def test_absent_tables_and_duplicates_are_profiled(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (1, None)], "k long, s string")
    got = {r.table_name: tuple(r)[1:] for r in prof.table_profile({"t": df}, ["u"]).collect()}
    assert got == {"t": (4, 2, 3, 2), "u": (None, None, None, None)}


def test_range_path_has_no_row_level_single_task_window(spark):
    df = spark.range(0, 2000).withColumn("v", F.col("id") % 7)
    ranked = global_row_number(df, ["v", "id"], "rn")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "row_number()" not in plan


def test_hot_key_is_split_across_range_partitions(spark):
    # one customer holds a third of all rows: ranking on (customer, unique id)
    # must spread that customer over several partitions, not one task
    n = 3000
    rows = [(0 if i % 3 == 0 else i, i) for i in range(n)]
    df = spark.createDataFrame(rows, "cust long, id long")
    ranked = global_row_number(df, ["cust", "id"], "rn", num_partitions=8)
    parts = (df.repartitionByRange(8, "cust", "id").filter("cust = 0")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1
    exp = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy("cust", "id"))).collect()}
    assert {r.id: r.rn for r in ranked.collect()} == exp


def test_attach_scalar_subquery(spark):
    from ledgerlens.operators.scalars import attach
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k long, v double")
    one = df.agg(F.sum("v").alias("t"), F.count("v").alias("n"))
    got = [(r.k, r.t, r.n) for r in attach(df, one).orderBy("k").collect()]
    assert got == [(1, 5.0, 2), (2, 5.0, 2)]
    empty = df.filter("k > 9").agg(F.sum("v").alias("t"))  # global aggregate: one null row
    assert [r.t for r in attach(df, empty).collect()] == [None, None]
    plan = attach(df, one)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "NestedLoopJoin" not in plan


def test_lookup_small_dedups_and_defaults(spark):
    from ledgerlens.operators.lookup import lookup_small
    small = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 1.0)], "k long, v double")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (9, "z")], "id long, name string")
    got = {(r.k, r.v, r.name) for r in
           lookup_small(small, "k", dim, "id", ["name"], default={"name": "Unknown"}).collect()}
    assert got == {(1, 10.0, "a"), (2, 5.0, "c"), (3, 1.0, "Unknown")}


def test_lookup_small_keeps_rows_sharing_a_lookup_key(spark):
    from ledgerlens.operators.lookup import lookup_small
    small = spark.createDataFrame([(1, 7, 10.0), (1, 8, 5.0)], "p long, s long, v double")
    dim = spark.createDataFrame([(1, "x")], "id long, name string")
    got = {(r.p, r.s, r.name) for r in
           lookup_small(small, "p", dim, "id", ["name"], row_key=["p", "s"]).collect()}
    assert got == {(1, 7, "x"), (1, 8, "x")}
