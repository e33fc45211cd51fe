"""Sinks: CSV without index, and a long cell table written as a matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header; quotes inside quoted text are doubled."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


#: columns that a written matrix may have; more is an error
MAX_COLUMNS = 10_000


def matrix(cells: DataFrame, row: str, col: str, value: str,
           col_values: Sequence | None = None) -> DataFrame:
    """Pivot long cells (row, col, value) to one column per ``col`` value.

    Pass ``col_values`` when known; otherwise the distinct labels are read
    first, MAX_COLUMNS of them at most.
    """
    if col_values is None:
        col_values = [r[0] for r in cells.select(col).distinct().orderBy(col).limit(MAX_COLUMNS + 1).collect()]
        if len(col_values) > MAX_COLUMNS:
            raise ValueError(f"{col} has more than {MAX_COLUMNS} labels")
    wide = cells.groupBy(row).pivot(col, list(col_values)).agg(F.first(value))
    return wide.select(row, *[F.col(str(v)) for v in col_values])


def write_matrix_csv(cells: DataFrame, row: str, col: str, value: str, path: str,
                     col_values: Sequence | None = None) -> tuple[str, list]:
    m = matrix(cells, row, col, value, col_values)
    write_csv(m, path)
    return path, [c for c in m.columns if c != row]
