"""Typed CSV reading with pandas-like missing tokens and coercion.

Everything is read as text first (no schema inference, so a dirty value can
never change a column's type), missing tokens become null, and each field
is converted with a ``try_`` cast so a bad value becomes null instead of
failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text tokens pandas' read_csv treats as missing by default.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                    "n/a", "nan", "null"]


def normalize_missing(df: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """String cells equal to a missing token become null."""
    cols = set(columns if columns is not None else
               [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    toks = F.array(*[F.lit(t) for t in tokens])
    # one projection (a withColumn loop would re-analyse the plan per column)
    return df.select(*[
        (F.when(F.array_contains(toks, F.col(f"`{c}`")), F.lit(None).cast("string"))
         .otherwise(F.col(f"`{c}`")).alias(c)) if c in cols else F.col(f"`{c}`")
        for c in df.columns])


def parse_timestamp(cell: Column) -> Column:
    """A timestamp from the ISO layouts with and without a time; anything else is null."""
    return F.coalesce(F.try_to_timestamp(cell, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")),
                      F.try_to_timestamp(cell, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")),
                      F.try_to_timestamp(cell, F.lit("yyyy-MM-dd")))


def convert(c: str, dtype: T.DataType) -> Column:
    """A text column as ``dtype``; a cell that is none becomes null."""
    col = F.col(c)
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # 'NaN' text casts to NaN; missing values are kept as null, never NaN
        return F.nanvl(col.try_cast(dtype), F.lit(None).cast(dtype))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return parse_timestamp(col).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.to_date(F.try_to_timestamp(col, F.lit("yyyy-MM-dd")))
    return col.try_cast(dtype)


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text; quotes inside quoted text are doubled."""
    return (spark.read.option("header", True).option("inferSchema", False).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("nullValue", None).option("emptyValue", "").csv(path))


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   tokens: Sequence[str] = PANDAS_NA_TOKENS, multi_line: bool = False) -> DataFrame:
    """Read CSV with a header as pandas does, typed by ``schema``.

    Columns are matched by their name in the header, whatever their order; a
    column that the header lacks is null, one that the schema lacks is dropped.
    Quotes inside quoted text are doubled. ``multi_line`` allows line breaks in
    quoted text; such a file cannot be split, so it is off unless asked for.
    """
    raw = read_csv_text(spark, path, multi_line)
    raw = raw.select(*[F.col(f"`{f.name}`").cast("string") if f.name in raw.columns
                       else F.lit(None).cast("string").alias(f.name) for f in schema.fields])
    # tokens only need replacing in text targets: every other target is
    # converted with a try_ cast, which already turns them into null
    text_cols = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    raw = normalize_missing(raw, tokens, text_cols) if text_cols else raw
    return raw.select(*[convert(f"`{f.name}`", f.dataType).alias(f.name) for f in schema.fields])
