"""Named analyses of the loading side: inferred CSV, failing files, bad lines, file order.

The CSV inputs are written by Spark from the driver's tables under the checkpoint
folder, whole, with flaws that depend on the data, and are read back without a schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.catalog import UNSPECIFIED_PRIORITY, query
from ledgerlens.operators import file_order
from ledgerlens.operators import profile as prof
from ledgerlens.operators.scalars import with_row
from ledgerlens.session import scratch_path
from ledgerlens.sources import infer, sinks, tables
from ledgerlens.sources.csv import normalize_missing
from ledgerlens.sources.lines import ParsedLines, bad_line_counts, read_csv_lines
from ledgerlens.sources.tables import read_table


def _orders_as_text(spark: SparkSession, d: str) -> DataFrame:
    """Orders as text columns, one for each way a type comes about."""
    o = read_table(spark, d, "orders")
    day, priority, status = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"), F.col("o_orderstatus")
    last = F.col("o_orderkey") == F.col("_last")
    return o.transform(with_row(o.agg(F.max("o_orderkey").alias("_last")))).select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(priority == "5-LOW", "NA").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(status == "F", F.floor("o_totalprice").cast("string"))
        .otherwise(F.format_string("%.2f", "o_totalprice")).alias("price"),
        day.alias("ordered"),
        F.when(status == "O", F.concat(day, F.lit(" 12:30:00"))).otherwise(day).alias("placed"),
        F.when(priority == "1-URGENT", "True").otherwise("False").alias("rush"),
        F.when(last, "unknown batch").otherwise(F.col("o_custkey").cast("string")).alias("batch"),
        F.when(status == "P", "n/a").otherwise("NULL").alias("note"),
        priority.alias("priority"))


def _inferred(spark: SparkSession, d: str):
    return infer.read_csv_inferred(spark, sinks.write_csv(_orders_as_text(spark, d), scratch_path(spark, "orders-text")))


@query
def csv_inferred_types(spark, d):
    """Names, inferred types and missing counts of orders read from text without a schema."""
    return infer.column_report(spark, _inferred(spark, d)[1])


@query
def csv_inferred_orders(spark, d):
    """The same orders with every column in its inferred type."""
    return _inferred(spark, d)[0]


# The tables of the load report's folder and the state each is put into.
REPORT_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query
def table_load_report(spark, d):
    """What the loader makes of a folder in which nation is CSV, supplier is text under
    a Parquet name, part has undecodable bytes and lineitem is not there."""
    folder = scratch_path(spark, "load-report")
    for name in ("region", "customer", "orders", "events"):
        read_table(spark, d, name).write.parquet(tables.table_path(folder, name))
    sinks.write_csv(read_table(spark, d, "nation"), tables.table_path(folder, "nation", "csv"))
    read_table(spark, d, "supplier").select(F.col("s_name")).write.text(tables.table_path(folder, "supplier"))
    (read_table(spark, d, "part").select("p_partkey", F.col("p_name"))
     .write.option("header", True).option("encoding", "UTF-16").csv(tables.table_path(folder, "part", "csv")))
    _, states = tables.load_report(spark, folder, REPORT_TABLES, formats=("parquet", "csv"))
    return spark.createDataFrame([(s.table, s.state, s.reason, s.file_format, s.n_rows) for s in states],
                                 "table_name string, state string, reason string, file_format string, n_rows long")


_LINE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "remark"]


def _order_line() -> Column:
    """Orders as CSV lines: open orders of top priority leave a quote open, partly filled
    ones have a field too many, other low-priority ones lack two."""
    key, cust, status = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    price = F.when(F.col("o_orderpriority") == "2-HIGH", "n/a").otherwise(F.format_string("%.2f", "o_totalprice"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    said = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', ""checked""'))
    remark = F.concat(said, F.lit('"'))
    return (F.when(status == "P", F.concat_ws(",", key, cust, status, price, day, remark, F.lit("late")))
            .when((status == "O") & (F.col("o_orderpriority") == "1-URGENT"), F.concat_ws(",", key, cust, status, price, day, said))
            .when(F.col("o_orderpriority") == "5-LOW", F.concat_ws(",", key, cust, status, remark))
            .otherwise(F.concat_ws(",", key, cust, status, price, day, remark)))


def _order_lines(spark: SparkSession, d: str) -> ParsedLines:
    path = scratch_path(spark, "order-lines")
    # the CSV writer puts the header into every file; without quotes and with a separator that no line has, it writes lines as they are
    (read_table(spark, d, "orders").select(_order_line().alias(",".join(_LINE_COLUMNS)))
     .write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path))
    return read_csv_lines(spark, path)


@query
def csv_quarantine(spark, d):
    """The lines that are no rows, with their reason."""
    return _order_lines(spark, d).quarantine.select("reason", "line")


@query
def csv_parsed_orders(spark, d):
    """The lines that are rows, typed by inference."""
    raw = normalize_missing(_order_lines(spark, d).rows)
    return infer.typed(raw, infer.infer_columns(raw))


@query
def csv_quality_report(spark, d):
    """Missing cells, duplicate rows and bad lines of the orders file, where there are any."""
    parsed = _order_lines(spark, d)
    return (prof.quality_issues({"orders_csv": normalize_missing(parsed.rows)})
            .unionByName(bad_line_counts(parsed.quarantine, "orders_csv")))


@query
def last_company_in_file(spark, d):
    """Per customer: orders and the last company in file order, an unspecified one counting as missing."""
    o = file_order.with_file_order(read_table(spark, d, "orders"), ["o_custkey", "o_orderkey", "o_orderpriority"])
    o = o.withColumn("company", F.nullif(F.col("o_orderpriority"), F.lit(UNSPECIFIED_PRIORITY)))
    return (o.filter(F.col("o_custkey").isNotNull()).groupBy("o_custkey")
            .agg(F.count("o_orderkey").alias("order_count"), file_order.last_non_null("company").alias("company")))


@query
def employee_first_last_line(spark, d):
    """Per employee: product and order of the first matching and of the last duplicate line."""
    li, s = read_table(spark, d, "lineitem"), read_table(spark, d, "supplier").select("s_suppkey", "s_name")
    out = file_order.lookup_first(s, "s_suppkey", li, "l_suppkey", ["l_partkey", "l_orderkey"])
    out = out.withColumnsRenamed({"l_partkey": "first_part", "l_orderkey": "first_order"})
    out = file_order.lookup_last(out, "s_suppkey", li, "l_suppkey", ["l_partkey", "l_orderkey"])
    return out.withColumnsRenamed({"l_partkey": "last_part", "l_orderkey": "last_order"})
