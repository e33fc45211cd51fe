"""File order: which row came first or last in the files a table was read from.

Spark rows have no order, but every row of a file source has an address: its file
and its row number there (``_metadata``). ``with_file_order`` adds it as one integer,
files in the order of their paths, so that it is the same however the scan is
partitioned. On top of it:

* ``first_match``: a name lookup that takes the first row of a key;
* ``last_duplicate``: a dictionary whose later rows overwrite earlier ones;
* ``last_non_null``: ``groupby.last()``.

Lookups keep one fixed-width state per key (the winning address), in a hash
aggregate; the attributes are fetched by address afterwards, so a key repeated by a
third of the rows is combined map-side and no text sits in an aggregation buffer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = "_ll_file_order"
#: a file's rows are numbered below 2**40, files below 2**23
_ROW_BITS = 40


def with_file_order(table: DataFrame, columns: Sequence[str] | None = None, name: str = ORDER) -> DataFrame:
    """``columns`` of a Parquet table with each row's place in file order."""
    # one row per file: a bounded side
    files = table.select(F.col("_metadata.file_path").alias("_ll_file")).distinct()
    number = F.row_number().over(Window.orderBy("_ll_file")) - 1
    files = files.withColumn("_ll_no", number.cast("long"))
    kept = [F.col(f"`{c}`") for c in (columns or table.columns)]
    rows = table.select(*kept, F.col("_metadata.file_path").alias("_ll_file"), F.col("_metadata.row_index").alias("_ll_row"))
    return (rows.join(F.broadcast(files), "_ll_file")
            .withColumn(name, F.shiftleft("_ll_no", _ROW_BITS) + F.col("_ll_row"))
            .drop("_ll_file", "_ll_row", "_ll_no"))


def _picked(ordered: DataFrame, key: str, pick) -> DataFrame:
    """The rows at the picked address of every non-null key."""
    rows = ordered.filter(F.col(key).isNotNull())
    wanted = rows.groupBy(key).agg(pick(ORDER).alias(ORDER))
    return rows.join(wanted, [key, ORDER], "left_semi").drop(ORDER)


def first_match(dim: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """One row per key: its first row in file order."""
    return _picked(with_file_order(dim, [key, *attrs]), key, F.min)


def last_duplicate(dim: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """One row per key: its last row in file order."""
    return _picked(with_file_order(dim, [key, *attrs]), key, F.max)


def last_non_null(value: str, order: str = ORDER) -> Column:
    """``groupby.last()``: the last value that is not null, by file order."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def lookup_first(small: DataFrame, small_key: str, dim: DataFrame, dim_key: str, attrs: Sequence[str],
                 default: dict | None = None) -> DataFrame:
    """Name lookup, first match wins; unmatched rows get the default."""
    return _looked_up(small, small_key, first_match(dim, dim_key, attrs), dim_key, default)


def lookup_last(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, attrs: Sequence[str],
                default: dict | None = None) -> DataFrame:
    """Dictionary lookup, last duplicate wins; unmatched rows get the default (or null)."""
    return _looked_up(fact, fact_key, last_duplicate(dim, dim_key, attrs), dim_key, default)


def _looked_up(rows: DataFrame, key: str, dim: DataFrame, dim_key: str, default: dict | None) -> DataFrame:
    out = rows.join(dim.withColumnRenamed(dim_key, key), key, "left")
    for name, value in (default or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out
