"""CSV lines that do not parse: kept apart with their file and reason, never turned into rows.

A line is judged by itself, so files stay splittable (line breaks inside quoted text
are not supported here). It is bad if a quote is left open, or if it has more or
fewer fields than the header; ``from_csv`` with a corrupt-record column has the
last word on the rest. Good lines become rows of text columns; bad ones make the
quarantine table (source_file, reason, line). Blank lines are skipped, as pandas
does. Header lines are the lines equal to the first one: each file starts with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN_QUOTE, TOO_MANY, TOO_FEW, UNREADABLE = "open_quote", "too_many_fields", "too_few_fields", "unreadable"
_CORRUPT = "_ll_corrupt"


@dataclass(frozen=True)
class ParsedLines:
    rows: DataFrame        # text columns named by the header
    quarantine: DataFrame  # source_file, reason, line


def n_fields(line: Column, sep: str = ",") -> Column:
    """Fields of a line whose quotes are closed."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def bad_reason(line: Column, fields: int, sep: str = ",") -> Column:
    """Why a line cannot be a row of ``fields`` fields; null if nothing speaks against it."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    found = n_fields(line, sep)
    return (F.when(quotes % 2 == 1, OPEN_QUOTE).when(found > fields, TOO_MANY).when(found < fields, TOO_FEW))


def read_csv_lines(spark: SparkSession, path: str, sep: str = ",") -> ParsedLines:
    """Split a CSV file or folder with a header into rows and a quarantine."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"),
                                         F.rtrim(F.col("value"), F.lit("\r")).alias("line"))
    lines = lines.filter(F.trim("line") != "")
    header = lines.select("line").first()
    if header is None:
        raise ValueError(f"no columns to parse in {path}")
    options = {"sep": sep, "quote": '"', "escape": '"', "emptyValue": "", "mode": "PERMISSIVE"}
    names = [r[0] for r in spark.createDataFrame([(header[0],)], "h string").select(
        F.explode(F.split("h", f"{sep}(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"))).collect()]
    names = [n[1:-1].replace('""', '"') if n[:1] == n[-1:] == '"' and len(n) > 1 else n for n in names]
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    judged = (lines.filter(F.col("line") != header[0])
              .withColumn("reason", bad_reason(F.col("line"), len(names), sep))
              .withColumn("parsed", F.when(F.col("reason").isNull(), F.from_csv(
                  "line", f"{schema}, {_CORRUPT} string", {**options, "columnNameOfCorruptRecord": _CORRUPT})))
              .withColumn("reason", F.when(F.col(f"parsed.{_CORRUPT}").isNotNull(), UNREADABLE).otherwise(F.col("reason"))))
    rows = judged.filter(F.col("reason").isNull()).select(*[F.col(f"parsed.c{i}").alias(n) for i, n in enumerate(names)])
    return ParsedLines(rows, judged.filter(F.col("reason").isNotNull()).select("source_file", "reason", "line"))


def bad_line_counts(quarantine: DataFrame, table_name: str) -> DataFrame:
    """Rows of the quality report: (table_name, issue, column_name, n) per reason."""
    return (quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(table_name).alias("table_name"), F.concat(F.lit("bad_lines:"), "reason").alias("issue"),
                    F.lit(None).cast("string").alias("column_name"), "n"))
