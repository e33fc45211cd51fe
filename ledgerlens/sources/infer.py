"""CSV with inferred column types: one distributed pass over a type lattice.

Every cell is read as text and classified; a column's type is the least upper
bound of its cells:

    missing < integer < float < text
    missing < date < timestamp < text
    missing < boolean < text

The state of a column is a set of seen classes, one bit each, merged by
``bit_or``: it is fixed-width, combines map-side in any order, and a single dirty
cell anywhere decides the type however the file is split. Missing cells are
counted in the same aggregate, so types and missing counts cost one scan.

Rules kept from pandas' reader: missing tokens never decide a type; a column of
missing cells only is float; ``True``/``False`` columns are boolean. Unlike it, an
integer column with missing cells stays integer (nulls need no float), a boolean one stays boolean, and an
integer beyond 64 bits makes its column text, so that no digit is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.csv import PANDAS_NA_TOKENS, convert, normalize_missing, parse_timestamp, read_csv_text

INTEGER, FLOAT, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(6))

_INTEGER = r"^\s*[+-]?\d+\s*$"
_FLOAT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}"
# The spellings pandas reads as booleans.
_BOOLEANS = ["True", "TRUE", "true", "False", "FALSE", "false"]


@dataclass(frozen=True)
class InferredColumn:
    name: str
    data_type: T.DataType
    n_missing: int
    n_rows: int


def cell_class(cell: Column) -> Column:
    """The lattice bit of one cell; a missing cell (null) has none."""
    whole = F.when(cell.try_cast("long").isNotNull(), INTEGER).otherwise(TEXT)
    return (F.when(cell.isNull(), 0)
            .when(cell.rlike(_INTEGER), whole)
            .when(cell.rlike(_FLOAT), FLOAT)
            .when(cell.rlike(_DATE) & parse_timestamp(cell).isNotNull(), DATE)
            .when(cell.rlike(_TIMESTAMP) & parse_timestamp(cell).isNotNull(), TIMESTAMP)
            .when(cell.isin(_BOOLEANS), BOOLEAN)
            .otherwise(TEXT))


def join_classes(seen: int) -> T.DataType:
    """The type of a column whose cells were of the classes in ``seen``."""
    for allowed, dtype in ((0, T.DoubleType()), (INTEGER, T.LongType()), (INTEGER | FLOAT, T.DoubleType()),
                           (DATE, T.DateType()), (DATE | TIMESTAMP, T.TimestampNTZType()), (BOOLEAN, T.BooleanType())):
        if not seen & ~allowed:
            return dtype
    return T.StringType()


def infer_columns(raw: DataFrame) -> list[InferredColumn]:
    """Types and missing counts of text columns whose missing cells are null, from one aggregate."""
    cells = [F.col(f"`{c}`") for c in raw.columns]
    row = raw.agg(F.count(F.lit(1)).alias("n"), *[F.bit_or(cell_class(c)).alias(f"s{i}") for i, c in enumerate(cells)],
                  *[F.count(c).alias(f"p{i}") for i, c in enumerate(cells)]).first()
    return [InferredColumn(c, join_classes(row[f"s{i}"] or 0), row["n"] - row[f"p{i}"], row["n"])
            for i, c in enumerate(raw.columns)]


def typed(raw: DataFrame, columns: Sequence[InferredColumn]) -> DataFrame:
    """Text columns converted to their inferred types."""
    return raw.select(*[convert(f"`{c.name}`", c.data_type).alias(c.name) for c in columns])


def read_csv_inferred(spark: SparkSession, path: str, tokens: Sequence[str] = PANDAS_NA_TOKENS,
                      multi_line: bool = False) -> tuple[DataFrame, list[InferredColumn]]:
    """A CSV file or folder with a header and no schema: the typed rows and what was inferred."""
    raw = normalize_missing(read_csv_text(spark, path, multi_line), tokens)
    columns = infer_columns(raw)
    return typed(raw, columns), columns


def column_report(spark: SparkSession, columns: Sequence[InferredColumn]) -> DataFrame:
    """(position, column_name, data_type, n_missing, n_rows) of inferred columns."""
    return spark.createDataFrame(
        [(i, c.name, c.data_type.simpleString(), c.n_missing, c.n_rows) for i, c in enumerate(columns, 1)],
        "position int, column_name string, data_type string, n_missing long, n_rows long")
