"""Sources and sinks: table loader, CSV sink, matrix sink."""

from ledgerlens.session import scratch_path
from ledgerlens.sources import sinks
from ledgerlens.sources.tables import load_tables

SF = "/root/testdata/sf0.001"


def test_load_tables_skips_missing(spark):
    tables, missing = load_tables(spark, SF, ["region", "no_such_table", "nation"])
    assert set(tables) == {"region", "nation"} and missing == ["no_such_table"]
    assert tables["nation"].count() == 25


def test_matrix_sink_round_trip(spark):
    cells = spark.createDataFrame([("2024-01", 1, 100.0), ("2024-01", 2, 50.0), ("2024-02", 1, 100.0)],
                                  "cohort_month string, cohort_index long, v double")
    path, cols = sinks.write_matrix_csv(cells, "cohort_month", "cohort_index", "v",
                                        scratch_path(spark, "matrix-test"))
    assert cols == ["1", "2"]
    schema = "cohort_month string, `1` double, `2` double"
    back = {r["cohort_month"]: (r["1"], r["2"]) for r in
            spark.read.schema(schema).option("header", True).csv(path).collect()}
    assert back == {"2024-01": (100.0, 50.0), "2024-02": (100.0, None)}


def test_csv_reads_as_pandas_does(spark, tmp_path):
    import pandas as pd
    from pyspark.sql import types as T

    from ledgerlens.sources.csv import read_csv_typed
    (tmp_path / "x.csv").write_text('name,id,v\n"a ""q"", b",1,2.5\n"two\nlines",2,\nNA,3,x\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("v", T.DoubleType()), T.StructField("gone", T.StringType())])
    got = [tuple(r) for r in read_csv_typed(spark, str(tmp_path / "x.csv"), schema, multi_line=True).orderBy("id").collect()]
    pdf = pd.read_csv(tmp_path / "x.csv")
    names = [None if pd.isna(x) else x for x in pdf["name"]]
    assert got == [(1, names[0], 2.5, None), (2, names[1], None, None), (3, None, None, None)]
