"""Fixed-width states: bitmap words, coded labels, observed metrics, value-count modes."""

import os
import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import bitmaps, labels
from ledgerlens.operators import profile as prof
from ledgerlens.plans import customer_value as cv
from ledgerlens.plans import customers, outputs
from ledgerlens.session import scratch_path

EXTREMES = [0, 1, 63, 64, -1, -64, -65, 2 ** 62, -(2 ** 63), 2 ** 63 - 1]


def test_distinct_counts_of_integers(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, rnd.randrange(-300, 300), *EXTREMES]), rnd.randrange(5)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a long, b int").repartition(5)
    got = bitmaps.distinct_counts(df, {"na": "a", "nb": "b"}, rows="n").first()
    assert tuple(got) == (2000, len({a for a, _ in rows if a is not None}), 5)
    empty = bitmaps.distinct_counts(df.filter("b > 9"), {"na": "a"}, rows="n").first()
    assert tuple(empty) == (0, 0)


def test_distinct_counts_add_up_over_levels(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2, 3]), rnd.choice([None, rnd.randrange(100)])) for _ in range(900)]
    levels = {"all": ["g", "m"], "g": ["g"], "m": ["m"], "total": []}
    got = {(r.level, r.g, r.m): r.n_distinct for r in bitmaps.distinct_rollup(
        spark.createDataFrame(rows, "g string, m int, v long"), "v", ["g", "m"], levels).collect()}
    frame = pd.DataFrame(rows, columns=["g", "m", "v"])
    want = {("all", g, int(m)): n for (g, m), n in frame.groupby(["g", "m"])["v"].nunique().items()}
    want |= {("g", g, None): n for g, n in frame.groupby("g")["v"].nunique().items()}
    want |= {("m", None, int(m)): n for m, n in frame.groupby("m")["v"].nunique().items()}
    want[("total", None, None)] = frame["v"].nunique()
    assert got == want


def test_words_are_hash_aggregated(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    plan = bitmaps.counted(bitmaps.words(df, "id", ["g"]), ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_key_differences_equal_sets(spark):
    rnd = random.Random(6)
    child = [rnd.choice([None, rnd.randrange(400), *EXTREMES]) for _ in range(600)]
    parent = [rnd.choice([None, rnd.randrange(300), *EXTREMES[:5]]) for _ in range(600)]
    text = [None if c is None else f"k{c}" for c in child]
    c = spark.createDataFrame(list(zip(child, text)), "k long, t string").repartition(4)
    p = spark.createDataFrame([(x, None if x is None else f"k{x}") for x in parent], "k long, t string")
    nobody = p.filter("k is null")
    got = {r[0]: tuple(r)[1:] for r in prof.orphan_report(
        [("a", c, "k", p, "k"), ("b", p, "k", c, "k"), ("text", c, "t", p, "t"), ("none", c.filter("k > 2000000000000000000000"), "k", p, "k"),
         ("all", c, "k", nobody, "k")]).collect()}
    cs, ps = {x for x in child if x is not None}, {x for x in parent if x is not None}
    assert got == {"a": (len(cs), len(cs - ps), 1), "b": (len(ps), len(ps - cs), 1), "text": (len(cs), len(cs - ps), 1),
                   "none": (0, 0, 0), "all": (len(cs), len(cs), 1)}


def _facts(spark, n=400):
    rnd = random.Random(8)
    rows = [(rnd.randrange(20), None if i == 3 else rnd.choice([i, -i]), rnd.choice([None, date(2000, 1, 1) + timedelta(rnd.randrange(5))]),
             rnd.choice([None, "b", "a", "Ä", ""])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "customer_key long, _order long, order_date date, company string")


def test_last_label_equals_the_text_state(spark):
    _, df = _facts(spark)
    known = labels.dictionary(df, "company")
    assert known == ["", "a", "b", "Ä"]
    coded = (df.groupBy("customer_key").agg(labels.last_label("company", known, "order_date", "_order").alias("x"))
             .select("customer_key", labels.decode(F.col("x"), known).alias("x")))
    plain = df.groupBy("customer_key").agg(cv.last_non_null("company", "order_date", "_order").alias("x"))
    assert {r[0]: r[1] for r in coded.collect()} == {r[0]: r[1] for r in plain.collect()}


def test_more_labels_than_are_coded(spark, monkeypatch):
    _, df = _facts(spark)
    facts = df.withColumn("margin", F.lit(1).cast("decimal(18,2)")).withColumn("volume", F.lit(2).cast("decimal(28,2)"))
    cust = spark.createDataFrame([(i, "t") for i in range(20)], "c long, tier string")
    want = {tuple(r) for r in cv.volume_margin(facts, cust, "c", ["tier"]).collect()}
    monkeypatch.setattr(labels, "MAX_LABELS", 2)
    assert labels.dictionary(df, "company") is None
    assert {tuple(r) for r in cv.volume_margin(facts, cust, "c", ["tier"]).collect()} == want
    assert labels.dictionary(df.filter("1 = 0"), "company") == []


def test_customer_aggregate_keeps_fixed_width_states(spark):
    from ledgerlens import catalog
    plan = catalog.volume_margin(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "max_by" in line]
    assert grouped and all("HashAggregate" in line and "ObjectHashAggregate" not in line for line in grouped)


def test_modes_and_distincts(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, "a", 2.0), (2, "b", None), (1, "a", 5.0), (None, None, None)], "k int, t string, v double")
    row = customers.basic_stats(df, "v", ["k", "t"], "t", "a").first()
    assert (row.n_customers, row.n_distinct_v, row.n_distinct_k, row.n_distinct_t) == (5, 2, 2, 2)
    assert (row.mode_k, row.mode_t, row.n_flagged) == (1, "a", 2)
    nothing = customers.basic_stats(df.filter("k is null"), "v", ["k"], "t", "a").first()
    assert nothing.mode_k is None and nothing.n_distinct_k == 0


def test_metrics_are_observed_while_writing(spark):
    df = spark.createDataFrame([(1, 2.5, "ab", None), (2, None, "c", date(2024, 1, 2)), (3, 1.5, None, None)],
                               "i int, x double, t string, d date").repartition(3)
    path = scratch_path(spark, "observed")
    got = outputs.write_observed(df, path)
    assert got == {"n_rows": 3, "n_columns": 4, "n_cells": 8, "total": 10.0, "n_chars": 13}
    outputs.verify_rows(spark, {"a": (path, 3)})


def test_a_truncated_file_is_detected(spark, tmp_path):
    path = str(tmp_path / "out")
    got = outputs.write_observed(spark.range(100).coalesce(1).selectExpr("id", "id * 2 as x"), path)
    part, = [p for p in os.listdir(path) if p.endswith(".csv")]
    whole = (tmp_path / "out" / part).read_text()
    (tmp_path / "out" / part).write_text(whole[:len(whole) // 2].rsplit("\n", 1)[0] + "\n")
    os.remove(tmp_path / "out" / f".{part}.crc")
    with pytest.raises(ValueError, match="rows written"):
        outputs.verify_rows(spark, {"x": (path, got["n_rows"])})


def test_members_are_counted_per_customer(spark):
    rng = random.Random(8)
    orders = [(i, None if i % 17 == 0 else i % 9) for i in range(200)] + [(300, 100)]
    # order 5 holds a third of the lines
    lines = [(5 if n % 3 == 0 else rng.randrange(220), rng.choice([None, -70, 0, *range(100)]), rng.choice(["a", "b", None]))
             for n in range(1500)] + [(None, 1, "a"), (300, None, "a")]
    facts = spark.createDataFrame([(c, i) for i, c in orders if c is not None], f"{cv.KEY} long, _order long")
    df = spark.createDataFrame(lines, "o long, p long, t string").repartition(4)
    want = {}
    for o, p, t in lines:
        c = dict(orders).get(o)
        if c is not None:
            held = want.setdefault(c, (set(), set()))
            held[0].update([p] if p is not None else [])
            held[1].update([t] if t is not None else [])
    counts = cv.member_counts(facts, df, "o", {"n_p": "p", "n_t": "t"})
    assert {r[0]: (r.n_p, r.n_t) for r in counts.collect()} == {c: (len(p), len(t)) for c, (p, t) in want.items()}
    assert cv.member_counts(facts, df.limit(0), "o", {"n_p": "p"}).collect() == []


def test_features_keep_fixed_width_states(spark):
    from ledgerlens import catalog
    plan = catalog.customer_features(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and "collect_set" not in plan
    assert "ObjectHashAggregate(keys=[cust" not in plan and "ObjectHashAggregate(keys=[_order" not in plan
