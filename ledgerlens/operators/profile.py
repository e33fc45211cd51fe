"""Data-quality operators: missing cells, duplicate rows, orphan keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import bitmaps
from ledgerlens.session import scratch_path


def null_counts(df: DataFrame) -> DataFrame:
    """Long form (column_name, n_null, n_rows) from a single scan."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("n_null"))
                      for i, c in enumerate(df.columns)])
    return one.select(F.col("_rows").alias("n_rows"), F.explode(pairs).alias("p")).select(
        "p.column_name", "p.n_null", "n_rows")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: number of rows that repeat an earlier identical row
    (``duplicated().sum()``; nulls compare equal because grouping does)."""
    return df.sparkSession.createDataFrame([(scan_profile(df).n_duplicates,)], "n_duplicates long")


@dataclass(frozen=True)
class TableProfile:
    n_rows: int
    n_null: dict[str, int]
    n_duplicates: int


def scan_profile(df: DataFrame) -> TableProfile:
    """Rows, null counts per column and duplicate rows from one scan.

    Nulls are observed while the rows are counted by a 64-bit hash, eight bytes per
    row; only if a hash repeats are the rows with such a hash read again and grouped
    by all their columns.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(c.isNull()).alias(f"c{i}") for i, c in enumerate(cols)]]
    hashed = df.observe(seen, *counts).select(F.xxhash64(*cols).alias("_ll_h"))
    path = scratch_path(df.sparkSession, "repeated-hashes")
    hashed.groupBy("_ll_h").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_ll_h").write.parquet(path)
    repeated = df.sparkSession.read.schema("_ll_h long").parquet(path)
    n_duplicates = 0
    if not repeated.isEmpty():
        groups = (df.withColumn("_ll_h", F.xxhash64(*cols)).join(repeated, "_ll_h", "left_semi").groupBy(*cols)
                  .agg(F.count(F.lit(1)).alias("_c")))
        n_duplicates = groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long")).first()[0]
    found = seen.get
    return TableProfile(found["n"], {c: found[f"c{i}"] for i, c in enumerate(df.columns)}, n_duplicates)


def table_profile(tables: Mapping[str, DataFrame], absent: Sequence[str] = ()) -> DataFrame:
    """Per table: rows, columns, missing cells, duplicate rows; an absent table has nulls."""
    spark, rows = SparkSession.active(), []
    for name, df in tables.items():
        p = scan_profile(df)
        rows.append((name, p.n_rows, len(df.columns), sum(p.n_null.values()), p.n_duplicates))
    return spark.createDataFrame(rows + [(name, None, None, None, None) for name in absent],
                                 "table_name string, n_rows long, n_columns long, n_missing long, n_duplicates long")


def quality_issues(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Only the problems: per column missing counts > 0 and duplicate rows > 0."""
    issues = []
    for name, df in tables.items():
        p = scan_profile(df)
        issues += [(name, "missing", c, n) for c, n in p.n_null.items() if n]
        issues += [(name, "duplicate_rows", None, p.n_duplicates)] if p.n_duplicates else []
    return SparkSession.active().createDataFrame(issues, "table_name string, issue string, column_name string, n long")


def orphan_keys(check: str, child: DataFrame, child_key: str,
                parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys absent from the parent (set difference of keys).

    Keys are compared in their own types (1 and 1.0 are equal), one column of
    each table is read, and an empty child gives a row of zeros; a null child key is reported apart (a Python set keeps one NaN).
    """
    keys = child.select(F.col(child_key).alias("_k")).distinct()
    parents = (parent.select(F.col(parent_key).alias("_k")).filter(F.col("_k").isNotNull())
               .distinct().withColumn("_seen", F.lit(True)))
    j = keys.join(parents, "_k", "left")
    return j.agg(F.count(F.col("_k")).alias("n_child_keys"),
                 F.count_if(F.col("_k").isNotNull() & F.col("_seen").isNull()).alias("n_orphan_keys"),
                 F.count_if(F.col("_k").isNull()).alias("n_null_keys")).select(
        F.lit(check).alias("check_name"), "n_child_keys", "n_orphan_keys", "n_null_keys")


def orphan_report(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """``orphan_keys`` of several (name, child, key, parent, key): integer keys by bitmap
    words, every table scanned once; keys of other types by their joins."""
    plain = [c for c in checks if bitmaps.is_integer(c[1], c[2]) and bitmaps.is_integer(c[3], c[4])]
    parts = [bitmaps.key_differences(plain)] if plain else []
    return union_all(parts + [orphan_keys(*c) for c in checks if c not in plain])


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
