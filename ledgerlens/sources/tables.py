"""Registry of the star-schema tables and a loader that skips what cannot be loaded.

Every table is probed on its own: a path that is not there is ``absent``, one that
cannot be read is ``corrupt``, and both are reported with a reason while the other
tables load. The probe asks the format what a reader needs before the first row:
Parquet the footers of all files (a count answered from them), CSV the header and,
as pandas does, text that decodes as UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver's star / event tables used by the analyses.
STAR_TABLES = ["region", "nation", "customer", "supplier", "part",
               "orders", "lineitem", "events"]

LOADED, ABSENT, CORRUPT = "loaded", "absent", "corrupt"
#: what a failing probe raises: Spark's own errors and those of its file readers
_FAILURES = (PySparkException, Py4JJavaError, ValueError)


@dataclass(frozen=True)
class TableState:
    table: str
    state: str
    reason: str | None
    file_format: str | None
    n_rows: int | None
    detail: str | None = None


def table_path(base_dir: str, name: str, file_format: str = "parquet") -> str:
    return f"{base_dir.rstrip('/')}/{name}.{file_format}"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; filters and projections reach the reader."""
    return spark.read.parquet(table_path(base_dir, name))


def _read_parquet(spark: SparkSession, path: str, deep: bool) -> tuple[DataFrame, int | None]:
    df = spark.read.parquet(path)
    return df, df.count() if deep else None  # the count opens every footer and no page


def _read_csv(spark: SparkSession, path: str, deep: bool) -> tuple[DataFrame, int | None]:
    from ledgerlens.sources.csv import read_csv_text
    df = read_csv_text(spark, path)
    if not df.columns:
        raise ValueError("no columns to parse")
    if not deep:
        return df, None
    undecoded, lines = spark.read.text(path).agg(
        F.count_if(~F.is_valid_utf8("value")), F.count(F.lit(1))).first()
    if undecoded:
        raise ValueError(f"{undecoded} of {lines} lines are not UTF-8")
    return df, df.count()


_READERS = {"parquet": _read_parquet, "csv": _read_csv}


def probe_table(spark: SparkSession, base_dir: str, name: str, formats: Sequence[str] = ("parquet",),
                deep: bool = True) -> tuple[DataFrame | None, TableState]:
    """The table in the first format found there, and what became of it.

    ``deep`` opens every file; otherwise one file's schema is enough.
    """
    for fmt in formats:
        try:
            df, rows = _READERS[fmt](spark, table_path(base_dir, name, fmt), deep)
            return df, TableState(name, LOADED, None, fmt, rows)
        except _FAILURES as e:
            if isinstance(e, AnalysisException) and e.getCondition() == "PATH_NOT_FOUND":
                continue
            first_line = str(e).strip().splitlines()[0][:300] if str(e).strip() else type(e).__name__
            return None, TableState(name, CORRUPT, f"not readable as {fmt}", fmt, None, first_line)
    return None, TableState(name, ABSENT, "no such file", None, None)


def load_report(spark: SparkSession, base_dir: str, names: Iterable[str] = STAR_TABLES,
                formats: Sequence[str] = ("parquet",), deep: bool = True) -> tuple[dict[str, DataFrame], list[TableState]]:
    """Every table that loads, and one state for each name."""
    tables, states = {}, []
    for name in names:
        df, state = probe_table(spark, base_dir, name, formats, deep)
        states.append(state)
        if df is not None:
            tables[name] = df
    return tables, states


def load_tables(spark: SparkSession, base_dir: str,
                names: Iterable[str] = STAR_TABLES,
                register_views: bool = False) -> tuple[dict[str, DataFrame], list[str]]:
    """Load every named table; an absent or corrupt one is skipped and reported."""
    tables, states = load_report(spark, base_dir, names, deep=False)
    if register_views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables, [s.table for s in states if s.state != LOADED]
