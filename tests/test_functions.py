"""Scalar semantics on tiny fixtures."""

import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.bins import cut
from ledgerlens.functions.exprs import (coerce_date, coerce_number, contains_safe, first_word,
                                        last_dash_word, month_index, pct, qcut_rank_bin,
                                        round_half_even, safe_div, starts_with_safe, date_or_na)
from ledgerlens.functions.rules import rfm_segment, two_way_label, vip_tier, wheel_category


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_cut_right_closed_lowest_excluded_outside_null(spark):
    # bins_edge: values on each edge, 0, above the top, null
    df = spark.createDataFrame([(0.0,), (18.0,), (18.5,), (100.0,), (101.0,), (None,)], "x double")
    label, order = cut("x", [0, 18, 100], ["a", "b"])
    got = rows(df.select(label.alias("l"), order.alias("o")), "l", "o")
    assert got == [(None, None), ("a", 1), ("b", 2), ("b", 2), (None, None), (None, None)]


def test_cut_matches_pandas(spark):
    vals = [0, 1, 18, 19, 23, 24, 55, 56, 99, 100, 101, -3]
    edges, labels = [0, 10, 19, 24, 60, 99], ["u", "a", "b", "c", "d"]
    expect = [None if pd.isna(v) else str(v) for v in pd.cut(pd.Series(vals), edges, labels=labels)]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    label, _ = cut("x", edges, labels)
    assert [r[0] for r in df.select(label).collect()] == expect


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 8, 11, 13, 37, 100, 251])
def test_qcut_rank_bin_equals_pandas(spark, n):
    ranks = pd.Series(range(1, n + 1), dtype=float)
    if n == 1:
        expect = [1]
    else:
        expect = list(pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int))
    df = spark.range(1, n + 1).withColumn("n", F.lit(n))
    got = [r[0] for r in df.orderBy("id").select(qcut_rank_bin("id", "n")).collect()]
    assert got == expect


def test_coerce_number_and_date(spark):
    # orders_dirty: bad number text, bad date text, empty and NA-like strings
    df = spark.createDataFrame([("12.5", "2024-01-31"), ("x", "not a date"), (None, None),
                                ("", "2024/02/01")], "p string, d string")
    got = rows(df.select(coerce_number("p").cast("double").alias("p"),
                         coerce_date("d").cast("string").alias("d")), "p", "d")
    assert got == [(12.5, "2024-01-31"), (0.0, None), (0.0, None), (0.0, "2024-02-01")]


def test_unicode_words_and_dash_suffix(spark):
    # viet_text: 'Phòng Xe cơ giới', '--', null, NFD form
    nfd = unicodedata.normalize("NFD", "Phòng Kế toán")
    df = spark.createDataFrame([("Phòng Xe cơ giới",), ("--",), (None,), (nfd,),
                                ("NV-Hà",), ("4-NOT SPECIFIED",)], "s string")
    got = rows(df.select(first_word("s").alias("w"), last_dash_word("s").alias("t")), "w", "t")
    assert got[0] == ("Phòng", None)
    assert got[1] == (None, None)
    assert got[2] == (None, None)
    assert got[3][0] is not None and got[3][0].startswith("Pho")
    assert got[4] == ("NV", "Hà")
    assert got[5] == ("4", None)


def test_null_safe_string_predicates(spark):
    df = spark.createDataFrame([("DC01",), (None,), ("XDC",)], "s string")
    got = rows(df.select(starts_with_safe("s", "DC").alias("a"), contains_safe("s", "DC").alias("b")),
               "a", "b")
    assert got == [(True, True), (False, False), (False, True)]


def test_half_even_rounding_and_safe_division(spark):
    df = spark.createDataFrame([(0.125, 1.0, 0.0), (2.5, 4.0, 2.0)], "x double, a double, b double")
    got = rows(df.select(round_half_even("x", 2).alias("r"), safe_div("a", "b").alias("d"),
                         pct("a", "b").alias("p")), "r", "d", "p")
    assert got == [(0.12, None, None), (2.5, 2.0, 200.0)]


def test_month_index_and_date_or_na(spark):
    df = spark.createDataFrame([("2023-11-15", "2024-02-01")], "a string, b string").select(
        F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert df.select(month_index("b", "a")).first()[0] == 4
    e = spark.createDataFrame([(None,)], "d date")
    assert e.select(date_or_na(F.col("d"))).first()[0] == "N/A"


def test_rule_tables(spark):
    df = spark.createDataFrame(
        [(5, 5, 5), (4, 3, 3), (5, 1, 2), (3, 3, 3), (3, 2, 5), (2, 4, 4), (1, 1, 1), (2, 3, 3),
         (3, 1, 1), (5, 1, 5)], "r int, f int, m int")
    got = [r[0] for r in df.select(rfm_segment("r", "f", "m")).collect()]
    assert got == ["Champions", "Loyal Customers", "New Customers", "Potential Loyalists",
                   "Big Spenders (New)", "At Risk", "Lost", "Need Attention", "About to Sleep",
                   "Big Spenders (New)"]
    t = spark.createDataFrame([(15,), (14,), (11,), (8,), (7,)], "t int")
    assert [r[0] for r in t.select(vip_tier("t")).collect()] == [
        "Platinum", "Platinum", "Gold", "Silver", "Bronze"]
    s = spark.createDataFrame([(2,), (4,), (3,), (None,)], "s int")
    assert [r[0] for r in s.select(wheel_category("s")).collect()] == [
        "2-wheel", "4-wheel", "Other", "Other"]
    lab = spark.createDataFrame([("Vàng",), ("Bạc",), (None,)], "x string")
    assert [r[0] for r in lab.select(two_way_label("x", ["Vàng"])).collect()] == ["High", "Low", "Low"]


def test_mode_ties_pick_smallest(spark):
    # mode_ties: two equally frequent values
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "x string")
    assert df.agg(F.mode("x", True)).first()[0] == "a"


def test_read_csv_typed_missing_tokens(spark, tmp_path):
    from pyspark.sql import types as T
    from ledgerlens.sources.csv import read_csv_typed
    path = tmp_path / "t.csv"
    path.write_text("a,b,c,d\nx,1.5,2024-01-02,7\nNA,NaN,not a date,n/a\nnull,,2024-13-01,3\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType()),
                           T.StructField("c", T.DateType()), T.StructField("d", T.LongType())])
    got = [tuple(r) for r in read_csv_typed(spark, str(path), schema).collect()]
    import datetime
    assert got == [("x", 1.5, datetime.date(2024, 1, 2), 7), (None, None, None, None),
                   (None, None, None, 3)]


def test_qcut_rank_bin_all_n_up_to_300(spark):
    # randomised/brute-force check of the exact bin formula against pandas.qcut
    rows = [(n, r) for n in range(2, 301) for r in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n long, r long")
    got = {(a.n, a.r): a.b for a in df.select("n", "r", qcut_rank_bin("r", "n").alias("b")).collect()}
    for n in range(2, 301):
        exp = pd.qcut(pd.Series(range(1, n + 1), dtype=float), 5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert [got[(n, r)] for r in range(1, n + 1)] == list(exp), n
