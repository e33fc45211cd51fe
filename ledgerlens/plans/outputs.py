"""Export of the customer-analytics datasets as CSV files (the output writer).

Long tables are written as they are; the four cohort tables are written as
matrices (cohort x month index), the renewal ones re-indexed onto the
retention matrix's month columns. What is written is counted and summed while it is
written (observed metrics), and one job counts the rows of all files afterwards: a
file that lost rows is an error.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.profile import union_all
from ledgerlens.sources import sinks

_TOTAL = "decimal(38,6)"


def numbers_of(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _metrics(df: DataFrame, numbers: list[str]) -> list[Column]:
    """Rows, cells that are not empty, exact total of the numeric cells, characters of the others."""
    def summed(parts: list[Column], kind: str) -> Column:
        return reduce(add, parts, F.lit(0).cast(kind))
    cells = [F.col(f"`{c}`") for c in df.columns]
    values = [F.coalesce(F.sum(F.col(f"`{c}`").cast(_TOTAL)), F.lit(0).cast(_TOTAL)) for c in numbers]
    texts = [F.coalesce(F.sum(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0)) for c in df.columns if c not in numbers]
    return [F.count(F.lit(1)).alias("n_rows"), summed([F.count(c) for c in cells], "long").alias("n_cells"),
            summed(values, _TOTAL).cast("double").alias("total"), summed(texts, "long").alias("n_chars")]


def write_observed(df: DataFrame, path: str, numbers: list[str] | None = None) -> dict:
    """Write one dataset as CSV and return the metrics of what was written."""
    seen = Observation()
    sinks.write_csv(df.observe(seen, *_metrics(df, numbers_of(df) if numbers is None else numbers)), path)
    return {**seen.get, "n_columns": len(df.columns)}


def verify_rows(spark: SparkSession, written: Mapping[str, tuple[str, int]]) -> None:
    """Count the rows of all files (name -> path, rows written) in one job; a difference is an error."""
    found = union_all([
        spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n") for name, (path, _) in written.items()])
    wrong = {r.dataset: (written[r.dataset][1], r.n) for r in found.collect() if written[r.dataset][1] != r.n}
    if wrong:
        raise ValueError(f"files differ from what was written (rows written, rows found): {wrong}")


def export_datasets(spark: SparkSession, out_dir: str, tables: Mapping[str, DataFrame],
                    matrices: Mapping[str, tuple[DataFrame, str]], month_columns: list,
                    max_parallel_writes: int = 4) -> DataFrame:
    """Write ``tables`` as CSV and ``matrices`` (long cells, value column) as
    cohort matrices with ``month_columns``. Returns (dataset, n_rows, n_columns,
    n_cells that are not empty, total of the numeric cells as an exact decimal sum,
    n_chars of the other cells), observed during the writes."""
    def write_matrix(name: str, cells: DataFrame, value: str) -> dict:
        wide = sinks.matrix(cells, "cohort_month", "cohort_index", value, col_values=month_columns)
        return write_observed(wide, f"{out_dir}/{name}", [str(m) for m in month_columns])

    # the writes are independent jobs: submit them concurrently so the
    # scheduler can overlap them (Spark accepts jobs from several threads)
    with ThreadPoolExecutor(max_workers=max_parallel_writes) as pool:
        futures = {n: pool.submit(write_observed, df, f"{out_dir}/{n}") for n, df in tables.items()}
        futures |= {n: pool.submit(write_matrix, n, c, v) for n, (c, v) in matrices.items()}
        metrics = {n: f.result() for n, f in futures.items()}
    verify_rows(spark, {n: (f"{out_dir}/{n}", m["n_rows"]) for n, m in metrics.items()})
    return spark.createDataFrame(
        [(n, m["n_rows"], m["n_columns"], m["n_cells"], m["total"], m["n_chars"]) for n, m in metrics.items()],
        "dataset string, n_rows long, n_columns long, n_cells long, total double, n_chars long")
