"""The llm queries against their DuckDB SQL, and all of them on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.llm.oracle import SQL
from ledgerlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = [n.split("_")[0] for n in QUERIES if n != "pipeline"]
    assert names == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute(f"CREATE VIEW answer AS {SQL[name]}")
    found = con.execute("SELECT * FROM answer")
    cols = sorted(d[0] for d in found.description)
    order = [[d[0] for d in found.description].index(c) for c in cols]
    want = sorted(tuple(r[i] for i in order) for r in found.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == cols
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == want
