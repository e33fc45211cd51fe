"""Loading: inferred types, failing files, lines that do not parse, file order."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import file_order
from ledgerlens.session import scratch_path
from ledgerlens.sources import infer, tables
from ledgerlens.sources.csv import normalize_missing
from ledgerlens.sources.lines import bad_line_counts, read_csv_lines

CELLS = {  # cells of one column -> its type
    "integer": (["1", "-2", "+3", "NA", ""], T.LongType()),
    "float": (["1", "2.5", "nan", "1e3", ".5", "-inf"], T.DoubleType()),
    "missing": (["", "NULL", "n/a"], T.DoubleType()),
    "date": (["2024-02-29", "1999-12-31", "NA"], T.DateType()),
    "no date": (["2024-02-29", "2023-02-29"], T.StringType()),
    "stamp": (["2024-02-29", "2024-02-29 10:11:12"], T.TimestampNTZType()),
    "boolean": (["True", "false", "NA"], T.BooleanType()),
    "date and integer": (["2024-02-29", "7"], T.StringType()),
    "boolean and integer": (["True", "1"], T.StringType()),
    "too long": (["1", "92233720368547758080"], T.StringType()),
    "java suffix": (["1", "1d"], T.StringType()),
    "words": (["1", "x"], T.StringType()),
}


@pytest.mark.parametrize("name", CELLS)
def test_column_type_is_the_least_upper_bound(spark, name):
    cells, want = CELLS[name]
    for order in (cells, cells[::-1]):
        raw = normalize_missing(spark.createDataFrame([(c,) for c in order], "x string"))
        column, = infer.infer_columns(raw)
        assert column.data_type == want
        assert column.n_missing == sum(c in ("", "NA", "nan", "NULL", "n/a") for c in cells) and column.n_rows == len(cells)


def test_inference_on_no_rows(spark):
    column, = infer.infer_columns(spark.createDataFrame([], "x string"))
    assert (column.data_type, column.n_missing, column.n_rows) == (T.DoubleType(), 0, 0)


def test_a_dirty_last_row_changes_the_type_on_every_partitioning(spark):
    rows = [(str(i), str(i)) for i in range(999)] + [("999", "about 7")]
    for parts in (1, 3, 8):
        path = scratch_path(spark, f"infer-{parts}")
        spark.createDataFrame(rows, "a string, b string").repartitionByRange(parts, F.col("a").cast("int")).write.option(
            "header", True).csv(path)
        df, columns = infer.read_csv_inferred(spark, path)
        assert [c.data_type for c in columns] == [T.LongType(), T.StringType()]
        assert sorted(tuple(r) for r in df.collect()) == sorted((int(a), b) for a, b in rows)


def test_inference_reads_the_rows_once(spark):
    raw = spark.range(10).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    cells = [F.col(c) for c in raw.columns]
    plan = raw.agg(*[F.bit_or(infer.cell_class(c)) for c in cells])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_values_equal_pandas(spark, tmp_path):
    text = 'i,f,t,b\n1,2,"a, b",True\n-7,2.5,NA,False\n12,,"say ""x""",True\n'
    (tmp_path / "x.csv").write_text(text)
    df, _ = infer.read_csv_inferred(spark, str(tmp_path / "x.csv"))
    want = pd.read_csv(tmp_path / "x.csv").astype(object)
    want = want.where(want.notna(), None)
    assert [tuple(r) for r in df.orderBy(F.abs("i")).collect()] == sorted(want.itertuples(index=False, name=None), key=lambda r: abs(r[0]))


def _folder(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good.parquet"))
    (tmp_path / "garbage.parquet").write_bytes(b"PAR1 this is not a footer")
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "half.parquet"))
    (tmp_path / "half.parquet" / "part-zz.parquet").write_bytes(b"cut off")
    (tmp_path / "table.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "latin.csv").write_bytes("a,b\ncafé,1\n".encode("latin-1"))
    (tmp_path / "void.csv").write_text("")
    (tmp_path / "bare.parquet").mkdir()


def test_failing_tables_are_reported_and_the_others_load(spark, tmp_path):
    _folder(spark, tmp_path)
    names = ["good", "garbage", "half", "table", "latin", "void", "bare", "gone"]
    loaded, states = tables.load_report(spark, str(tmp_path), names, formats=("parquet", "csv"))
    assert {s.table: (s.state, s.file_format, s.n_rows) for s in states} == {
        "good": ("loaded", "parquet", 3), "garbage": ("corrupt", "parquet", None), "half": ("corrupt", "parquet", None),
        "table": ("loaded", "csv", 2), "latin": ("corrupt", "csv", None), "void": ("corrupt", "csv", None),
        "bare": ("corrupt", "parquet", None), "gone": ("absent", None, None)}
    assert set(loaded) == {"good", "table"} and loaded["table"].columns == ["a", "b"]
    assert all(s.detail for s in states if s.state == "corrupt")


def test_load_tables_skips_a_corrupt_file(spark, tmp_path):
    _folder(spark, tmp_path)
    loaded, skipped = tables.load_tables(spark, str(tmp_path), ["garbage", "good", "gone"])
    assert set(loaded) == {"good"} and skipped == ["garbage", "gone"]


def test_bad_lines_go_to_the_quarantine(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"k",v,"t, u"\n1,x,\n2,x\n\n3,"a, ""b""",y\r\n4,x,y,z\n5,x,"open\n')
    (tmp_path / "b.csv").write_text('"k",v,"t, u"\n6,"x""",y\n7,"x"",y\n8,,\n')
    parsed = read_csv_lines(spark, str(tmp_path))
    assert parsed.rows.columns == ["k", "v", "t, u"]
    assert sorted((tuple(r) for r in parsed.rows.collect()), key=str) == [
        ("1", "x", None), ("3", 'a, "b"', "y"), ("6", 'x"', "y"), ("8", None, None)]
    bad = sorted((r.reason, r.line, r.source_file.rsplit("/", 1)[1]) for r in parsed.quarantine.collect())
    assert bad == [("open_quote", '5,x,"open', "a.csv"), ("open_quote", '7,"x"",y', "b.csv"),
                   ("too_few_fields", "2,x", "a.csv"), ("too_many_fields", "4,x,y,z", "a.csv")]
    report = {r.issue: r.n for r in bad_line_counts(parsed.quarantine, "t").collect()}
    assert report == {"bad_lines:open_quote": 2, "bad_lines:too_few_fields": 1, "bad_lines:too_many_fields": 1}


def test_a_file_without_lines_has_no_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\n")
    with pytest.raises(ValueError):
        read_csv_lines(spark, str(tmp_path / "a.csv"))


@pytest.fixture(scope="module")
def duplicated(spark, tmp_path_factory):
    """A table with duplicate and null keys and null values over several files, and pandas' copy in file order."""
    folder, rnd = tmp_path_factory.mktemp("dup"), random.Random(5)
    frames = []
    for i in range(5):
        rows = [(rnd.choice([None, *range(30)]), rnd.choice([None, "x", "y", "z"]) if k % 3 else None, 1000 * i + k) for k in range(400)]
        frame = pd.DataFrame(rows, columns=["k", "v", "n"]).astype({"k": "Int64"})
        frame.to_parquet(folder / f"f{i}.parquet", index=False, row_group_size=64)
        frames.append(frame)
    return str(folder), pd.concat(frames, ignore_index=True)


@pytest.mark.parametrize("split_bytes", ["1k", "2k", "128m"])
def test_file_order_equals_pandas_on_any_partitioning(spark, duplicated, split_bytes):
    path, frame = duplicated
    frame = frame[frame["k"].notna()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        df = spark.read.parquet(path)
        first = {r.k: (r.v, r.n) for r in file_order.first_match(df, "k", ["v", "n"]).collect()}
        last = {r.k: (r.v, r.n) for r in file_order.last_duplicate(df, "k", ["v", "n"]).collect()}
        by_group = {r.k: r.v for r in file_order.with_file_order(df).filter("k is not null").repartition(7).groupBy("k")
                    .agg(file_order.last_non_null("v").alias("v")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")

    def plain(f):
        return {int(k): (v if isinstance(v, str) else None, int(n)) for k, v, n in f[["k", "v", "n"]].itertuples(index=False)}
    assert first == plain(frame.drop_duplicates("k", keep="first"))
    assert last == plain(frame.drop_duplicates("k", keep="last"))
    assert by_group == {int(k): v for k, v in frame.groupby("k")["v"].last().items()}


def test_lookups_by_file_order(spark, duplicated):
    path, frame = duplicated
    dim = spark.read.parquet(path).select("k", "n")
    keys = spark.createDataFrame([(1,), (999,), (None,)], "key long")
    got = {r.key: r.n for r in file_order.lookup_last(keys, "key", spark.read.parquet(path), "k", ["n"], {"n": -1}).collect()}
    assert got == {1: int(frame[frame["k"] == 1]["n"].iloc[-1]), 999: -1, None: -1}
    got = {r.key: r.n for r in file_order.lookup_first(keys, "key", dim, "k", ["n"]).collect()}
    assert got == {1: int(frame[frame["k"] == 1]["n"].iloc[0]), 999: None, None: None}
