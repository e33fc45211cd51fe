"""Named analyses bound to the driver's star tables.

Bindings (stand-ins for the insurance schema): ``orders`` are orders
(``o_custkey`` customer, ``o_orderdate`` signed date, ``o_totalprice`` money,
``o_orderstatus = 'P'`` renewal, ``o_orderpriority`` contract type);
``lineitem`` are order lines (``l_suppkey`` employee / sales channel,
``l_partkey`` product, ``l_quantity`` duration); supplier → nation → region
is employee → branch → company and channel → channel type; ``part`` are
vehicle models; ``customer.c_mktsegment`` is the tier, ``c_acctbal`` the
age-like number; ``events`` is the monthly KPI feed.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables; small intermediates that are read more than once are computed on the way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.exprs import (coerce_date, coerce_number, date_or_na, last_dash_word,
                                        mean_of_sum, money, month_start, round6,
                                        starts_with_safe)
from ledgerlens.functions.exprs import pct as pct_expr
from ledgerlens.functions.rules import two_way_label
from ledgerlens.operators import bitmaps
from ledgerlens.operators import crosstab as xt
from ledgerlens.operators import profile as prof
from ledgerlens.operators.lookup import lookup, lookup_small
from ledgerlens.operators.ranks import exact_quantiles
from ledgerlens.operators.rollups import bottom_k, describe, top_k, value_counts
from ledgerlens.operators.scalars import with_row
from ledgerlens.plans import cohort as cohort_plan
from ledgerlens.plans import customer_value as cv
from ledgerlens.plans import customers as cust_plan
from ledgerlens.plans import pareto as pareto_plan
from ledgerlens.plans import products as prod_plan
from ledgerlens.plans import rfm as rfm_plan
from ledgerlens.plans import sales as sales_plan
from ledgerlens.session import materialize, scratch_path
from ledgerlens.sources import sinks
from ledgerlens.sources.csv import PANDAS_NA_TOKENS, normalize_missing, read_csv_typed
from ledgerlens.sources.tables import STAR_TABLES, load_tables, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark, d, name):
    return read_table(spark, d, name)


# Balance groups used in the VIP list (stand-in for age groups).
VIP_BALANCE_EDGES = [-1000, 0, 2000, 4000, 6000, 8000, 10000]
VIP_BALANCE_LABELS = ["below 0", "0-2k", "2k-4k", "4k-6k", "6k-8k", "8k-10k"]


@query
def top_channels_by_revenue(spark, d):
    li = _t(spark, d, "lineitem")
    return sales_plan.top_by_revenue(li, "l_suppkey", "l_extendedprice", "l_orderkey", 10,
                                _t(spark, d, "supplier"), "s_suppkey", "s_name",
                                key_name="channel_key", name_len=40).drop("position")


@query
def rfm_scores(spark, d):
    return rfm_plan.with_double_money(rfm_plan.rfm(_t(spark, d, "orders")))


@query
def rfm_segment_summary(spark, d):
    return rfm_plan.segment_summary(rfm_plan.rfm(_t(spark, d, "orders")))


@query
def vip_list(spark, d):
    scored = rfm_plan.rfm(_t(spark, d, "orders"))
    out = rfm_plan.vip_list(scored, _t(spark, d, "customer"), "c_custkey",
                            ["c_acctbal", "c_mktsegment", "c_nationkey"], age_col="c_acctbal",
                            age_edges=VIP_BALANCE_EDGES, age_labels=VIP_BALANCE_LABELS)
    return rfm_plan.with_double_money(out)


# ---------------------------------------------------------------- cohorts

RENEWAL_STATUS = "P"


def _cohort_orders(spark, d):
    return cohort_plan.cohort_orders(_t(spark, d, "orders"), "o_custkey", "o_orderdate",
                                     "o_orderstatus")


@query
def cohort_retention(spark, d):
    return cohort_plan.retention(_cohort_orders(spark, d))


@query
def cohort_renewal(spark, d):
    return cohort_plan.renewal(_cohort_orders(spark, d), RENEWAL_STATUS)


@query
def cohort_matrix(spark, d):
    return cohort_plan.matrix_corner(cohort_plan.retention(_cohort_orders(spark, d)),
                                     "retention_pct")


@query
def cohort_rate_means(spark, d):
    co = _cohort_orders(spark, d)
    cells = cohort_plan.cohort_cells(co, RENEWAL_STATUS)
    return cohort_plan.rate_means(cohort_plan.retention(co, cells),
                                  cohort_plan.renewal(co, RENEWAL_STATUS, cells))


# ---------------------------------------------------------------- pareto
@query
def pareto_top(spark, d):
    return pareto_plan.pareto_top(
        pareto_plan.revenue_per_customer(_t(spark, d, "orders"), "o_custkey", "o_totalprice"))


@query
def pareto_80(spark, d):
    return pareto_plan.pareto_80(
        pareto_plan.revenue_per_customer(_t(spark, d, "orders"), "o_custkey", "o_totalprice"))


# ---------------------------------------------------------------- customer value
CUSTOMER_ATTRS = ["c_mktsegment", "c_acctbal", "c_nationkey"]


def _facts(spark, d):
    return cv.order_facts(_t(spark, d, "orders"), _t(spark, d, "lineitem"),
                          key="o_custkey", order_id="o_orderkey", date="o_orderdate",
                          amount="o_totalprice", company="o_orderpriority",
                          line_order_key="l_orderkey", line_price="l_extendedprice",
                          line_qty="l_quantity")


def _volume_margin(spark, d):
    return cv.volume_margin(_facts(spark, d), _t(spark, d, "customer"), "c_custkey",
                            CUSTOMER_ATTRS)


@query
def volume_margin(spark, d):
    return _volume_margin(spark, d)


@query
def volume_margin_corr(spark, d):
    return cv.volume_margin_corr(_volume_margin(spark, d))


@query
def volume_margin_tiers(spark, d):
    return cv.volume_margin_by_tier(_volume_margin(spark, d), "c_mktsegment")


def _feature_table(spark, d, scored=None):
    if scored is None:
        scored = rfm_plan.rfm(_t(spark, d, "orders"))
    # the facts feed the aggregate, its labels and the owners of the lines
    facts = materialize(_facts(spark, d))
    members = cv.member_counts(facts, _t(spark, d, "lineitem"), "l_orderkey",
                               {"n_products": "l_partkey", "n_channels": "l_suppkey"})
    feats = cv.feature_aggregates(facts, members)
    dates = _t(spark, d, "orders").select(F.to_date("o_orderdate").alias("order_date"))
    return cv.feature_table(scored, _t(spark, d, "customer"), "c_custkey", feats, dates)


@query
def customer_features(spark, d):
    return rfm_plan.with_double_money(_feature_table(spark, d))


@query
def feature_summary(spark, d):
    return cv.feature_summary(_feature_table(spark, d))


# ---------------------------------------------------------------- customers

# Segment display order (lowest to highest tier) and the high tiers.
TIER_ORDER = ["HOUSEHOLD", "FURNITURE", "BUILDING", "MACHINERY", "AUTOMOBILE"]
HIGH_TIERS = ["BUILDING", "MACHINERY", "AUTOMOBILE"]
# Balance bins (right-closed, lowest edge excluded); the last is empty.
BALANCE_EDGES = [0, 1000, 2500, 5000, 7500, 9000, 10000, 20000]
BALANCE_LABELS = ["0-1k", "1k-2.5k", "2.5k-5k", "5k-7.5k", "7.5k-9k", "9k-10k", "10k+"]
# Coarser balance segments for the margins crosstab.
SEGMENT_EDGES = [0, 2500, 5000, 7500, 10000]
SEGMENT_LABELS = ["Low (0-2.5k)", "Mid (2.5k-5k)", "Upper (5k-7.5k)", "Top (7.5k-10k)"]


def _customers_with_nation(spark, d):
    return lookup(_t(spark, d, "customer"), "c_nationkey", _t(spark, d, "nation"),
                  "n_nationkey", ["n_name"])


@query
def customer_basic_stats(spark, d):
    return cust_plan.basic_stats(_t(spark, d, "customer"), "c_acctbal",
                                 ["c_nationkey", "c_mktsegment"], "c_mktsegment", "BUILDING")


@query
def balance_describe(spark, d):
    return describe(_t(spark, d, "customer"), "c_acctbal")


@query
def segment_distribution(spark, d):
    return cust_plan.label_shares(_t(spark, d, "customer"), "c_mktsegment", TIER_ORDER)


@query
def tier_level_labels(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", "c_mktsegment",
                    two_way_label("c_mktsegment", HIGH_TIERS).alias("tier_level"))


@query
def balance_bins(spark, d):
    return cust_plan.bin_stats(_t(spark, d, "customer"), "c_acctbal", BALANCE_EDGES, BALANCE_LABELS)


@query
def crosstab_counts(spark, d):
    c = _customers_with_nation(spark, d)
    top = top_k(value_counts(c, "n_name", "n"), "n", "n_name", 10, rank_name=None).select("n_name")
    ct = xt.crosstab_counts(c, "n_name", "c_mktsegment")
    return ct.join(F.broadcast(top), "n_name")  # ten rows: bounded


@query
def crosstab_rowpct(spark, d):
    b = cust_plan.binned(_t(spark, d, "customer"), "c_acctbal", BALANCE_EDGES, BALANCE_LABELS)
    return xt.crosstab_row_pct(b, "bin_label", "c_mktsegment")


@query
def crosstab_margins(spark, d):
    c = cust_plan.binned(_t(spark, d, "customer"), "c_acctbal", SEGMENT_EDGES, SEGMENT_LABELS)
    c = c.withColumn("tier_level", two_way_label("c_mktsegment", HIGH_TIERS))
    return xt.crosstab_margins(c, "bin_label", "tier_level")


@query
def top_bottom_occupations(spark, d):
    c = _customers_with_nation(spark, d)
    vc = value_counts(c, "n_name", "n", "pct", share_of_rows=True)
    top = top_k(vc, "n", "n_name", 10, rank_name="rank").withColumn("position", F.lit("top"))
    bottom = bottom_k(vc, "n", "n_name", 5, rank_name="rank").withColumn("position", F.lit("bottom"))
    return top.unionByName(bottom)


# ---------------------------------------------------------------- orders and sales


def _employee_map(spark, d):
    return sales_plan.employee_map(_t(spark, d, "supplier"), _t(spark, d, "nation"),
                                   _t(spark, d, "region"))


def _supplier_totals(spark, d):
    return sales_plan.per_key_totals(_t(spark, d, "lineitem"), "l_suppkey", "l_extendedprice",
                                     "l_orderkey")


@query
def orders_per_customer_dist(spark, d):
    o = _t(spark, d, "orders").filter(F.col("o_custkey").isNotNull())
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders_per_customer"))
    return per.groupBy("orders_per_customer").agg(F.count(F.lit(1)).alias("n_customers"))


@query
def orders_per_customer_stats(spark, d):
    o = _t(spark, d, "orders").filter(F.col("o_custkey").isNotNull())
    per = materialize(o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k")))  # read twice
    stats = per.agg(F.count(F.lit(1)).alias("n_customers"), F.min("k").alias("min_orders"),
                    F.max("k").alias("max_orders"), round6(F.avg("k")).alias("mean_orders"),
                    F.count_if(F.col("k") > 1).alias("n_repeat_customers"))
    return (stats.transform(with_row(exact_quantiles(per, "k", [0.5], prefix="_q")))
            .withColumn("median_orders", round6("_q0")).drop("_q0"))


@query
def order_type_share(spark, d):
    o = _t(spark, d, "orders").filter(F.col("o_orderpriority").isNotNull())
    g = materialize(o.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.to_date(F.min("o_orderdate")).alias("first_order_date"),
        F.to_date(F.max("o_orderdate")).alias("last_order_date")))
    total = g.agg(F.sum("n").alias("_t"))
    return (g.transform(with_row(total))
            .select("o_orderpriority", "n", pct_expr("n", "_t").alias("pct"),
                    "first_order_date", "last_order_date"))


@query
def monthly_series(spark, d):
    o = _t(spark, d, "orders").filter(F.col("o_orderdate").isNotNull())
    return (o.groupBy(month_start("o_orderdate").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.sum(money("o_totalprice")).cast("double").alias("revenue"),
                 F.countDistinct("o_custkey").alias("n_customers")))


@query
def revenue_by_company(spark, d):
    return sales_plan.rollup_through_map(_supplier_totals(spark, d), "l_suppkey",
                                         _employee_map(spark, d), "s_suppkey", "company",
                                         "company").drop("n_keys")


@query
def channel_type_share(spark, d):
    r = sales_plan.rollup_through_map(_supplier_totals(spark, d), "l_suppkey",
                                      _employee_map(spark, d), "s_suppkey", "branch",
                                      "channel_type")
    return sales_plan.with_share(r.drop("n_keys", "avg_revenue"), "revenue", "share_pct")


@query
def company_comparison(spark, d):
    r = sales_plan.rollup_through_map(_supplier_totals(spark, d), "l_suppkey",
                                      _employee_map(spark, d), "s_suppkey", "company", "company")
    return r.select("company", "revenue", "n", F.col("n_keys").alias("n_employees"),
                    round6(F.try_divide(F.col("revenue"), F.col("n_keys").cast("double")))
                    .alias("revenue_per_employee"))


@query
def branch_performance(spark, d):
    r = sales_plan.rollup_through_map(_supplier_totals(spark, d), "l_suppkey",
                                      _employee_map(spark, d), "s_suppkey", "branch_key",
                                      "branch_key")
    top = top_k(r.drop("n_keys", "avg_revenue"), "revenue", "branch_key", 10, rank_name="rank")
    return lookup_small(top, "branch_key", _t(spark, d, "nation"), "n_nationkey", ["n_name"],
                        default={"n_name": "Unknown"})


@query
def employee_stats(spark, d):
    li = _t(spark, d, "lineitem")
    # one pass: the null-employee group carries the rest of the grand total
    per_all = materialize(li.groupBy("l_suppkey")
                          .agg(F.sum(money("l_extendedprice")).alias("revenue"),
                               F.count("l_orderkey").alias("contracts")))
    per = per_all.filter(F.col("l_suppkey").isNotNull())
    total = per_all.agg(F.sum("revenue").alias("_ll_total"))
    share = sales_plan.top_fraction_share(per, "l_suppkey", "revenue", 0.1, total)
    stats = per.agg(F.count(F.lit(1)).alias("n_employees"),
                    round6(mean_of_sum(F.sum("revenue"), F.count("revenue"))).alias("avg_revenue"))
    median = exact_quantiles(per, "contracts", [0.5], prefix="_q").select(round6("_q0").alias("median_contracts"))
    return stats.transform(with_row(median)).transform(with_row(share.select(pct_expr("_ll_top", "_ll_total").alias("top10pct_share"))))


@query
def kpi_by_type(spark, d):
    e = _t(spark, d, "events").filter(F.col("event_type").isNotNull())
    return (e.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum(money("value")).cast("double").alias("total_value"),
                 F.countDistinct("user_id").alias("n_users"),
                 F.min(month_start("ts")).alias("first_month"),
                 F.max(month_start("ts")).alias("last_month")))


@query
def prefix_lookup(spark, d):
    """Top employees; their base employee found by the first 16 code characters."""
    s = _t(spark, d, "supplier")
    # ten rows at most: looked up without de-duplicating the suppliers, and
    # only the suppliers of their base codes are grouped
    top = materialize(lookup_small(top_channels_by_revenue(spark, d), "channel_key",
                                   s.select("s_suppkey", F.col("s_name").alias("code")), "s_suppkey", ["code"])
                      .withColumn("base_code", F.substring("code", 1, 16)))
    wanted = F.broadcast(top.select("base_code").distinct())
    base = (s.withColumn("base_code", F.substring("s_name", 1, 16)).join(wanted, "base_code", "left_semi")
            .groupBy("base_code").agg(F.count(F.lit(1)).alias("base_size"), F.min("s_suppkey").alias("base_key")))
    return top.join(base, "base_code", "left")


# ---------------------------------------------------------------- products / vehicles

# Price ranges (right-closed; 900.0 itself falls outside, the last is empty).
PRICE_EDGES = [900, 925, 950, 975, 1000, float("inf")]
PRICE_LABELS = ["900-925", "925-950", "950-975", "975-1000", "1000+"]
ECONOMY_BELOW = 910
LUXURY_FROM = 995


@query
def part_price_describe(spark, d):
    p = _t(spark, d, "part")
    return describe(p, "p_retailprice").transform(with_row(
        p.agg(F.countDistinct("p_brand").alias("n_brands"),
              F.countDistinct("p_partkey").alias("n_models"))))


@query
def brand_stats(spark, d):
    return prod_plan.price_stats(_t(spark, d, "part"), "p_brand", "p_retailprice", "p_size")


@query
def size_profile(spark, d):
    return prod_plan.price_stats(_t(spark, d, "part"), "p_size", "p_retailprice", "p_brand")


@query
def price_ranges(spark, d):
    return prod_plan.price_ranges(_t(spark, d, "part"), "p_retailprice", PRICE_EDGES, PRICE_LABELS)


@query
def economy_parts(spark, d):
    p = _t(spark, d, "part").filter(F.col("p_retailprice") < ECONOMY_BELOW)
    return top_k(p.select("p_partkey", "p_name", "p_brand", "p_retailprice"),
                 "p_retailprice", "p_partkey", 10, ascending=True, rank_name="rank")


@query
def luxury_parts(spark, d):
    p = _t(spark, d, "part").filter(F.col("p_retailprice") >= LUXURY_FROM)
    top = top_k(p.select("p_partkey", "p_name", "p_brand", "p_retailprice"),
                "p_retailprice", "p_partkey", 10, rank_name="rank")
    n = p.agg(F.count(F.lit(1)).alias("n_luxury"))
    return top.transform(with_row(n))


@query
def vehicle_category(spark, d):
    return prod_plan.wheel_profile(_t(spark, d, "part"), "p_size", "p_retailprice")


@query
def model_name_counts(spark, d):
    vc = materialize(value_counts(_t(spark, d, "part"), "p_name", "n"))
    # the distinct count is the number of value-count rows: no second scan
    return vc.transform(with_row(vc.agg(F.count(F.lit(1)).alias("n_distinct_names"))))


@query
def product_sales(spark, d):
    return sales_plan.top_by_revenue(_t(spark, d, "lineitem"), "l_partkey", "l_extendedprice",
                                "l_orderkey", 15, _t(spark, d, "part"), "p_partkey", "p_name",
                                key_name="product_key", name_len=40, bottom=10)


@query
def product_channel_combo(spark, d):
    return prod_plan.top_pairs(
        _t(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], "l_extendedprice", "l_orderkey", 10,
        [(_t(spark, d, "part"), "p_partkey", "l_partkey", "p_name"),
         (_t(spark, d, "supplier"), "s_suppkey", "l_suppkey", "s_name")])


@query
def duration_stats(spark, d):
    li = _t(spark, d, "lineitem")
    # grouped once including the null duration, so the row total needs no scan
    g_all = materialize(li.groupBy("l_quantity")
                        .agg(F.count(F.lit(1)).alias("n"),
                             round6(mean_of_sum(F.sum(money("l_extendedprice")),
                                                F.count("l_extendedprice"))).alias("mean_price"),
                             round6(F.stddev_samp("l_extendedprice")).alias("std_price")))
    total = g_all.agg(F.sum("n").alias("_t"))
    g = g_all.filter(F.col("l_quantity").isNotNull())
    # per-group exact medians without a per-group map of every distinct price
    med = exact_quantiles(li.filter(F.col("l_quantity").isNotNull()), "l_extendedprice", [0.5],
                          groups=["l_quantity"], prefix="_med")
    g = g.join(med, "l_quantity", "left").withColumn("median_price", round6("_med0")).drop("_med0")
    return (g.transform(with_row(total))
            .withColumn("pct", pct_expr("n", "_t")).drop("_t"))


@query
def word_extract(spark, d):
    return prod_plan.word_profile(_t(spark, d, "part"), "p_name", "ring", "red")


@query
def priority_suffix(spark, d):
    o = _t(spark, d, "orders").withColumn("suffix", last_dash_word("o_orderpriority"))
    return value_counts(o, "suffix", "n", "pct", share_of_rows=False)


@query
def hierarchy_counts(spark, d):
    """Children per parent with zero kept: nations per region, suppliers and
    customers per nation."""
    region, nation = _t(spark, d, "region"), _t(spark, d, "nation")

    def children(level, parent, pkey, pname, child, ckey, cref):
        kids = child.filter(F.col(cref).isNotNull()).groupBy(F.col(cref).alias(pkey)).agg(
            F.count(ckey).alias("n_children"))
        return (parent.select(pkey, pname).join(kids, pkey, "left")
                .select(F.lit(level).alias("level"), F.col(pkey).cast("long").alias("parent_key"),
                        F.col(pname).alias("parent_name"),
                        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children")))

    return (children("region_nations", region, "r_regionkey", "r_name", nation, "n_nationkey", "n_regionkey")
            .unionByName(children("nation_suppliers", nation, "n_nationkey", "n_name",
                                  _t(spark, d, "supplier"), "s_suppkey", "s_nationkey"))
            .unionByName(children("nation_customers", nation, "n_nationkey", "n_name",
                                  _t(spark, d, "customer"), "c_custkey", "c_nationkey")))


@query
def dimension_listing(spark, d):
    n = _t(spark, d, "nation")
    return lookup(n, "n_regionkey", _t(spark, d, "region"), "r_regionkey", ["r_name"]).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name")


# ---------------------------------------------------------------- profile / quality / summary


# A priority label that the quality report treats as missing.
UNSPECIFIED_PRIORITY = "4-NOT SPECIFIED"
DIRECT_PREFIX = "1"


@query
def table_profile(spark, d):
    tables, absent = load_tables(spark, d, STAR_TABLES)
    return prof.table_profile(tables, absent)


def _type_family(dt: T.DataType) -> str:
    if isinstance(dt, T.IntegralType):
        return "integer"
    if isinstance(dt, (T.FractionalType,)):
        return "float"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dt, T.StringType):
        return "string"
    return dt.simpleString()


@query
def column_profile(spark, d):
    """Per table column: position, name, type family, null count, row count."""
    tables, absent = load_tables(spark, d, STAR_TABLES)
    parts = [spark.createDataFrame([(t,) for t in absent], "table_name string").select(
        "table_name", F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("column_name"),
        F.lit("absent").alias("data_type"), F.lit(None).cast("long").alias("n_null"),
        F.lit(None).cast("long").alias("n_rows"))] if absent else []
    for name, df in tables.items():
        fields = df.schema.fields
        pos = F.array_position(F.array(*[F.lit(f.name) for f in fields]), F.col("column_name"))
        types = F.element_at(F.array(*[F.lit(_type_family(f.dataType)) for f in fields]),
                             pos.cast("int"))
        parts.append(prof.null_counts(df).select(F.lit(name).alias("table_name"),
                                                 pos.alias("position"), "column_name",
                                                 types.alias("data_type"), "n_null", "n_rows"))
    return prof.union_all(parts)


@query
def quality_issues(spark, d):
    """Missing cells and duplicate rows of all tables, whole, and of one column cut."""
    tables, _ = load_tables(spark, d, STAR_TABLES)
    if "orders" in tables:
        tables["orders"] = normalize_missing(tables["orders"], PANDAS_NA_TOKENS + [UNSPECIFIED_PRIORITY])
    if "customer" in tables:
        tables["customer_segments"] = tables["customer"].select("c_nationkey", "c_mktsegment")
    return prof.quality_issues(tables)


@query
def referential_orphans(spark, d):
    checks = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
              ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey")]
    tables = {name: _t(spark, d, name) for check in checks for name in (check[0], check[2])}
    return prof.orphan_report([(f"{child}->{parent}", tables[child], key, tables[parent], parent_key)
                               for child, key, parent, parent_key in checks])


@query
def executive_summary(spark, d):
    """One row of headline numbers across all tables."""
    o, li, c = _t(spark, d, "orders"), _t(spark, d, "lineitem"), _t(spark, d, "customer")
    counts = {n: _t(spark, d, n).agg(F.count(F.lit(1)).alias(f"n_{n}"))
              for n in ["region", "nation", "supplier", "part"]}
    orders_row = o.agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(money("o_totalprice")).alias("_rev"),
        F.sum(F.when(starts_with_safe("o_orderpriority", DIRECT_PREFIX), money("o_totalprice"))).alias("_direct"),
        F.count("o_totalprice").alias("_n_price"),
        date_or_na(F.min(F.to_date("o_orderdate"))).alias("first_order_date"),
        date_or_na(F.max(F.to_date("o_orderdate"))).alias("last_order_date"),
        F.countDistinct(month_start("o_orderdate")).alias("active_months"))
    median = exact_quantiles(o, "o_totalprice", [0.5], prefix="_med")
    cust_row = c.agg(F.count(F.lit(1)).alias("n_customers"),
                     F.count_if(F.col("c_mktsegment").isin(HIGH_TIERS)).alias("n_high_tier"))
    li_row = li.agg(F.count(F.lit(1)).alias("n_order_lines"),
                    F.countDistinct("l_orderkey").alias("n_orders_with_lines"))
    brands = _t(spark, d, "part").agg(F.countDistinct("p_brand").alias("n_brands"))
    row = orders_row
    for extra in [median, cust_row, li_row, brands, *counts.values()]:
        row = row.transform(with_row(extra))  # one-row scalars
    return row.select(
        "n_region", "n_nation", "n_supplier", "n_part", "n_customers", "n_orders", "n_order_lines",
        F.coalesce(F.col("_rev"), F.lit(0)).cast("double").alias("total_revenue"),
        round6(F.coalesce(F.col("_rev"), F.lit(0)).cast("double") / F.lit(1e9)).alias("total_revenue_bn"),
        round6(mean_of_sum("_rev", "_n_price")).alias("avg_order_value"),
        round6("_med0").alias("median_order_value"),
        "first_order_date", "last_order_date", "active_months",
        "n_high_tier", pct_expr("n_high_tier", "n_customers").alias("high_tier_pct"),
        pct_expr(F.coalesce("_direct", F.lit(0)), "_rev").alias("direct_share_pct"),
        "n_orders_with_lines", "n_brands")


# The layout of orders written to and read back from CSV.
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])


def _dirty_orders(spark, d):
    """Orders rendered as text, with unparseable dates on low-priority orders
    and a missing-token price on urgent open orders (derived from the data)."""
    o = _t(spark, d, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_text"),
        F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"), F.lit("n/a"))
        .otherwise(F.format_string("%.2f", "o_totalprice")).alias("price_text"))


@query
def clean_orders(spark, d):
    raw = _dirty_orders(spark, d)
    dt = coerce_date("date_text")
    return raw.select(
        "o_orderkey", "o_custkey", dt.alias("order_date"),
        month_start(dt).alias("order_month"), F.year(dt).alias("order_year"),
        F.month(dt).alias("order_month_num"),
        coerce_number("price_text").cast("double").alias("price"))


@query
def csv_roundtrip(spark, d):
    path = sinks.write_csv(_t(spark, d, "orders"), scratch_path(spark, "orders-csv"))
    return read_csv_typed(spark, path, ORDERS_SCHEMA)


@query
def cohort_matrix_csv(spark, d):
    """The retention matrix written as CSV, read back and unpivoted to its cells."""
    # the cell table has at most months^2 rows; materialise it once so the
    # label read and the write do not both recompute the orders aggregate
    cells = materialize(cohort_plan.retention(_cohort_orders(spark, d)))
    path, cols = sinks.write_matrix_csv(cells, "cohort_month", "cohort_index", "retention_pct",
                                        scratch_path(spark, "cohort-matrix"))
    names = [str(c) for c in cols]
    schema = T.StructType([T.StructField("cohort_month", T.StringType())] +
                          [T.StructField(c, T.DoubleType()) for c in names])
    return (read_csv_typed(spark, path, schema)
            .unpivot("cohort_month", names, "cohort_index", "retention_pct")
            .where(F.col("retention_pct").isNotNull())
            .withColumn("cohort_index", F.col("cohort_index").cast("long")))


# ---------------------------------------------------------------- chart datasets
@query
def vip_tier_counts(spark, d):
    """VIP tier counts of the top-100 VIP list in fixed tier order."""
    vip = vip_list(spark, d)
    vc = value_counts(vip, "vip_tier", "n")
    order = F.array(*[F.lit(t) for t in ["Platinum", "Gold", "Silver", "Bronze"]])
    return vc.withColumn("display_order", F.array_position(order, F.col("vip_tier")))


@query
def renewal_matrix(spark, d):
    """Renewal-rate matrix corner: first 15 cohorts x month indices 1..12."""
    ren = cohort_plan.renewal(_cohort_orders(spark, d), RENEWAL_STATUS)
    return cohort_plan.matrix_corner(ren, "renewal_pct", n_cohorts=15)


@query
def scatter_axis_limits(spark, d):
    """95th percentiles of customer volume and margin (the scatter's axes)."""
    # per-customer table read by two quantile passes: checkpoint it once
    vm = materialize(_volume_margin(spark, d).select(cv.KEY, money("total_volume").alias("v"),
                                                     money("total_margin").alias("m")))
    qv = exact_quantiles(vm, "v", [0.95], prefix="volume_p")
    qm = exact_quantiles(vm, "m", [0.95], prefix="margin_p")
    return qv.transform(with_row(qm)).select(round6("volume_p0").alias("volume_p95"),
                                   round6("margin_p0").alias("margin_p95"))


@query
def export_outputs(spark, d):
    """The nine analysis datasets written as CSV under the checkpoint folder."""
    from ledgerlens.plans.outputs import export_datasets
    co = _cohort_orders(spark, d)
    cells = cohort_plan.cohort_cells(co, RENEWAL_STATUS)
    ret = cohort_plan.retention(co, cells)
    ren = cohort_plan.renewal(co, RENEWAL_STATUS, cells)
    # the matrix columns are retention's month indices (bounded by months)
    months = [r[0] for r in cells.select("cohort_index").distinct().orderBy("cohort_index").collect()]
    # one RFM computation feeds the RFM, VIP and feature exports
    scored = rfm_plan.rfm(_t(spark, d, "orders"))
    tables = {
        "rfm_segments": rfm_plan.with_double_money(scored),
        "vip_customers": rfm_plan.with_double_money(rfm_plan.vip_list(
            scored, _t(spark, d, "customer"), "c_custkey",
            ["c_acctbal", "c_mktsegment", "c_nationkey"], age_col="c_acctbal",
            age_edges=VIP_BALANCE_EDGES, age_labels=VIP_BALANCE_LABELS)),
        "pareto_analysis": pareto_top(spark, d),
        "volume_margin_scatter": volume_margin(spark, d),
        "feature_table": rfm_plan.with_double_money(_feature_table(spark, d, scored)),
    }
    matrices = {
        "cohort_retention_matrix": (ret, "retention_pct"),
        "cohort_pivot": (ret, "customers"),
        "renewal_rate_matrix": (ren, "renewal_pct"),
        "renewal_pivot": (ren, "renewals"),
    }
    return export_datasets(spark, scratch_path(spark, "exports"), tables, matrices, months)


# ---------------------------------------------------------------- counts of lines, employees, products, KPI
def _lines(spark, d):
    return _t(spark, d, "lineitem")


@query
def line_counts_by_part_type(spark, d):
    """Order lines per part type: count and share of all lines. Lines are counted
    per part first, so only one row per part meets the part table."""
    per_part = _lines(spark, d).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    named = lookup(per_part, "l_partkey", _t(spark, d, "part"), "p_partkey", ["p_type"])
    by_type = materialize(named.groupBy(F.coalesce("p_type", F.lit("Unknown")).alias("part_type"))
                          .agg(F.sum("n").alias("n_lines")))
    total = by_type.agg(F.sum("n_lines").alias("_total"))
    return (by_type.transform(with_row(total)).withColumn("pct", pct_expr("n_lines", "_total"))
            .select("part_type", "n_lines", "pct"))


@query
def insured_totals(spark, d):
    """Order lines, distinct parts and distinct orders among them."""
    return bitmaps.distinct_counts(_lines(spark, d), {"n_parts": "l_partkey", "n_orders": "l_orderkey"}, rows="n_lines")


@query
def distinct_customers_rollup(spark, d):
    """Customers that ordered: per month and region, per month, per region and in total, from one scan of the orders."""
    region_of = lookup(lookup(_t(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", _t(spark, d, "nation"),
                              "n_nationkey", ["n_regionkey"]), "n_regionkey", _t(spark, d, "region"), "r_regionkey", ["r_name"])
    o = lookup(_t(spark, d, "orders").select("o_custkey", month_start("o_orderdate").alias("month")), "o_custkey",
               region_of, "c_custkey", ["r_name"]).withColumnRenamed("r_name", "region")
    return bitmaps.distinct_rollup(o, "o_custkey", ["month", "region"],
                                   {"month and region": ["month", "region"], "month": ["month"], "region": ["region"], "total": []},
                                   "n_customers")


@query
def top_parts_by_lines(spark, d):
    """Fifteen parts with the most order lines, with name and share of rows."""
    vc = value_counts(_lines(spark, d), "l_partkey", "n_lines", "pct", share_of_rows=True)
    top = top_k(vc, "n_lines", "l_partkey", 15)
    return (lookup_small(top, "l_partkey", _t(spark, d, "part"), "p_partkey", ["p_name"],
                         default={"p_name": "Unknown"})
            .select("rank", "l_partkey", "p_name", "n_lines", "pct"))


def _per_employee(spark, d):
    rate = F.lit(1).cast("decimal(6,4)") - F.col("l_discount").cast("decimal(6,4)")
    li = _lines(spark, d).withColumn("_net", F.col("l_extendedprice").cast("decimal(18,2)") * rate)
    return (li.filter(F.col("l_suppkey").isNotNull()).groupBy("l_suppkey")
            .agg(F.coalesce(F.sum(money("l_extendedprice")), F.lit(0).cast("decimal(28,2)")).alias("_rev"),
                 F.count("l_extendedprice").alias("_vals"), F.count("l_orderkey").alias("n_contracts"),
                 F.sum("_net").alias("_net")))


@query
def employee_top10(spark, d):
    """Ten employees by revenue: sum, mean and number of contracts."""
    top = top_k(_per_employee(spark, d), "_rev", "l_suppkey", 10)
    return top.select("rank", "l_suppkey", F.col("_rev").cast("double").alias("revenue"),
                      round6(mean_of_sum("_rev", "_vals")).alias("avg_revenue"), "n_contracts")


@query
def employee_top20(spark, d):
    """Twenty employees by revenue with two money sums and their names."""
    top = top_k(_per_employee(spark, d), "_rev", "l_suppkey", 20)
    return (lookup_small(top, "l_suppkey", _t(spark, d, "supplier"), "s_suppkey", ["s_name"],
                         default={"s_name": "Unknown"})
            .select("rank", "l_suppkey", "s_name", F.col("_rev").cast("double").alias("revenue"),
                    F.col("_net").cast("double").alias("net_revenue"), "n_contracts"))


@query
def employee_medians(spark, d):
    """Median revenue and mean number of contracts per employee."""
    per = materialize(_per_employee(spark, d))  # read by the quantile and the mean
    median = exact_quantiles(per, "_rev", [0.5], prefix="_med")
    return (per.agg(F.count(F.lit(1)).alias("n_employees"),
                    round6(F.avg("n_contracts")).alias("avg_contracts"))
            .transform(with_row(median))
            .select("n_employees", round6("_med0").alias("median_revenue"), "avg_contracts"))


@query
def balance_by_segment(spark, d):
    """Mean, median and standard deviation of the balance per segment."""
    c = _t(spark, d, "customer").filter(F.col("c_mktsegment").isNotNull())
    stats = c.groupBy("c_mktsegment").agg(
        F.count("c_acctbal").alias("n"), round6(mean_of_sum(F.sum(F.col("c_acctbal").cast("decimal(38,6)")),
                                                            F.count("c_acctbal"))).alias("avg_balance"),
        round6(F.stddev_samp("c_acctbal")).alias("std_balance"))
    med = exact_quantiles(c, "c_acctbal", [0.5], groups=["c_mktsegment"], prefix="_m")
    return (stats.join(med, "c_mktsegment", "left")
            .select("c_mktsegment", "n", "avg_balance", round6("_m0").alias("median_balance"), "std_balance"))


@query
def quantity_describe(spark, d):
    """Eight-number summary of the line quantities (contract duration)."""
    return describe(_lines(spark, d), "l_quantity")


def _kpi(spark, d, key):
    e = _t(spark, d, "events").withColumn("_k", F.get_json_object("props", "$.k").try_cast("long"))
    return (e.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.coalesce(F.sum("_k"), F.lit(0)).cast("long").alias("contracts"),
                 F.coalesce(F.sum(money("value")), F.lit(0)).cast("double").alias("revenue")))


@query
def kpi_by_channel(spark, d):
    """Contracts and revenue of the KPI feed per channel (event type)."""
    return _kpi(spark, d, "event_type")


@query
def kpi_by_product(spark, d):
    """Contracts and revenue of the KPI feed per product (the part of the event's
    user number), the ten with most revenue, with names."""
    top = top_k(_kpi(spark, d, "user_id"), "revenue", "user_id", 10)
    return (lookup_small(top, "user_id", _t(spark, d, "part"), "p_partkey", ["p_name"], default={"p_name": "Unknown"})
            .select("rank", "user_id", "p_name", "contracts", "revenue"))


@query
def executive_lists(spark, d):
    """Top five products, channels and employees by revenue, as (list, rank, name, revenue, pct)."""
    li = _lines(spark, d).select("l_partkey", "l_suppkey", "l_extendedprice")

    def revenue(key):
        return li.groupBy(key).agg(F.coalesce(F.sum(money("l_extendedprice")), F.lit(0).cast("decimal(28,2)")).alias("_rev"))

    def top(name, df, key, label):
        return top_k(df, "_rev", key, 5).select(F.lit(name).alias("list"), "rank", label.alias("name"), "_rev")

    part, supplier = _t(spark, d, "part"), _t(spark, d, "supplier")
    per_part = revenue("l_partkey").filter(F.col("l_partkey").isNotNull())
    products = lookup_small(top_k(per_part, "_rev", "l_partkey", 5), "l_partkey", part, "p_partkey",
                            ["p_name"], default={"p_name": "Unknown"}).select(
        F.lit("products").alias("list"), "rank", F.col("p_name").alias("name"), "_rev")
    per_any = materialize(revenue("l_suppkey"))  # read by employees, channels and the total (with its null key)
    total = per_any.agg(F.sum("_rev").alias("_total"))
    per_supplier = per_any.filter(F.col("l_suppkey").isNotNull())
    employees = lookup_small(top_k(per_supplier, "_rev", "l_suppkey", 5), "l_suppkey", supplier, "s_suppkey",
                             ["s_name"], default={"s_name": "Unknown"}).select(
        F.lit("employees").alias("list"), "rank", F.col("s_name").alias("name"), "_rev")
    branch = sales_plan.employee_map(supplier, _t(spark, d, "nation"), _t(spark, d, "region"))
    by_branch = (per_supplier.join(branch.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")
                 .filter(F.col("branch").isNotNull()).groupBy("branch").agg(F.sum("_rev").alias("_rev")))
    channels = top("channels", by_branch, "branch", F.col("branch"))
    return (products.unionByName(channels).unionByName(employees).transform(with_row(total))
            .select("list", "rank", "name", F.col("_rev").cast("double").alias("revenue"),
                    pct_expr("_rev", "_total").alias("pct")))


@query
def executive_shares(spark, d):
    """Segment shares, mean part price, revenue per employee and the share of the
    top tenth of the employees, as (figure, name, value)."""
    seg = (value_counts(_t(spark, d, "customer"), "c_mktsegment", "n", "pct", share_of_rows=True)
           .select(F.lit("segment_pct").alias("figure"), F.col("c_mktsegment").alias("name"), F.col("pct").alias("value")))
    price = _t(spark, d, "part").agg(round6(mean_of_sum(F.sum(money("p_retailprice")), F.count("p_retailprice")))
                                     .alias("value"))
    per = materialize(_per_employee(spark, d).select("l_suppkey", "_rev"))
    total = per.agg(F.sum("_rev").alias("_total"))
    mean = per.agg(round6(mean_of_sum(F.sum("_rev"), F.count(F.lit(1)))).alias("value"))
    tenth = sales_plan.top_fraction_share(per, "l_suppkey", "_rev", 0.1, total).select(
        pct_expr("_ll_top", "_total").alias("value"))
    none = F.lit(None).cast("string").alias("name")
    return (seg.unionByName(price.select(F.lit("avg_part_price").alias("figure"), none, "value"))
            .unionByName(mean.select(F.lit("revenue_per_employee").alias("figure"), none, "value"))
            .unionByName(tenth.select(F.lit("top_tenth_employees_pct").alias("figure"), none, "value")))


@query
def product_listing(spark, d):
    """Product groups (brands) with their types and number of products."""
    # a brand's list is gathered from its distinct types, one row each
    pairs = (_t(spark, d, "part").filter(F.col("p_brand").isNotNull()).groupBy("p_brand", "p_type")
             .agg(F.count("p_partkey").alias("n")))
    return pairs.groupBy("p_brand").agg(F.sum("n").alias("n_products"),
                                        F.array_join(F.array_sort(F.collect_list("p_type")), ", ").alias("types"))


from ledgerlens import catalog_ingest  # noqa: E402,F401  (registers its queries)
