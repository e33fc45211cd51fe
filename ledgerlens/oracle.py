"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Conventions shared with the Spark side: money is summed as DECIMAL(18,2) and
cast to DOUBLE; means are CAST(sum AS DOUBLE) / count; other non-exact
doubles are rounded to 6 digits; integer results are BIGINT; every
ordering ends in a unique key.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["top_channels_by_revenue"] = """
WITH g AS (
  SELECT l_suppkey AS channel_key,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev,
         count(l_orderkey) AS n
  FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey),
t AS (
  SELECT *, row_number() OVER (ORDER BY rev DESC, channel_key) AS rnk FROM g
  QUALIFY rnk <= 10),
d AS (SELECT s_suppkey, min(s_name) AS s_name FROM supplier
      WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey)
SELECT t.channel_key, CAST(t.rev AS DOUBLE) AS revenue, t.n,
       coalesce(substr(d.s_name, 1, 40), 'Unknown') AS name,
       CAST(t.rnk AS BIGINT) AS rank
FROM t LEFT JOIN d ON d.s_suppkey = t.channel_key
"""

_RFM = """
WITH o AS (
  SELECT o_custkey AS customer_key, o_orderkey AS oid,
         CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS m
  FROM orders WHERE o_custkey IS NOT NULL),
ref AS (SELECT max(d) + 1 AS ref_date FROM o),
base AS (
  SELECT customer_key,
         CAST(date_diff('day', max(d), (SELECT ref_date FROM ref)) AS BIGINT) AS recency,
         count(oid) AS frequency, coalesce(sum(m), 0) AS monetary
  FROM o GROUP BY customer_key),
b AS (SELECT * FROM base WHERE recency IS NOT NULL),
e AS (SELECT quantile_cont(recency, 0.2) AS e1, quantile_cont(recency, 0.4) AS e2,
             quantile_cont(recency, 0.6) AS e3, quantile_cont(recency, 0.8) AS e4,
             count(*) AS n FROM b),
r AS (
  SELECT b.*, e.*,
         row_number() OVER (ORDER BY frequency, customer_key) AS f_rn,
         row_number() OVER (ORDER BY monetary, customer_key) AS m_rn
  FROM b CROSS JOIN e),
s AS (
  SELECT customer_key, recency, frequency, monetary,
    CAST(CASE WHEN recency <= e1 THEN 5 WHEN recency <= e2 THEN 4 WHEN recency <= e3 THEN 3
              WHEN recency <= e4 THEN 2 ELSE 1 END AS BIGINT) AS r_score,
    CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, (5 * (f_rn - 1) + n - 2) // (n - 1)) END AS BIGINT) AS f_score,
    CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, (5 * (m_rn - 1) + n - 2) // (n - 1)) END AS BIGINT) AS m_score
  FROM r),
rfm AS (
  SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
         r_score + f_score + m_score AS rfm_total,
         CASE
           WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
           WHEN r_score >= 4 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
           WHEN r_score >= 4 AND f_score <= 2 AND m_score <= 2 THEN 'New Customers'
           WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Potential Loyalists'
           WHEN r_score >= 3 AND f_score <= 2 AND m_score >= 4 THEN 'Big Spenders (New)'
           WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'At Risk'
           WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
           WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'Need Attention'
           WHEN r_score = 3 AND f_score <= 2 AND m_score <= 2 THEN 'About to Sleep'
           ELSE 'Others' END AS segment
  FROM s)"""

SQL["rfm_scores"] = _RFM + """
SELECT customer_key, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
       r_score, f_score, m_score, rfm_score, rfm_total, segment
FROM rfm
"""

SQL["rfm_segment_summary"] = _RFM + """,
g AS (SELECT segment, count(*) AS customer_count, sum(recency) AS sr, sum(frequency) AS sf,
             sum(monetary) AS sm FROM rfm GROUP BY segment),
t AS (SELECT sum(customer_count) AS tc, sum(sm) AS tm FROM g)
SELECT segment, customer_count,
       round_even(CAST(sr AS DOUBLE) / CAST(customer_count AS DOUBLE), 2) AS avg_recency,
       round_even(CAST(sf AS DOUBLE) / CAST(customer_count AS DOUBLE), 2) AS avg_frequency,
       round_even(CAST(sm AS DOUBLE) / CAST(customer_count AS DOUBLE), 2) AS avg_monetary,
       round_even(CAST(sm AS DOUBLE), 2) AS total_revenue,
       round_even(CAST(customer_count AS DOUBLE) / CAST(tc AS DOUBLE) * 100, 2) AS pct_customers,
       round_even(CAST(sm AS DOUBLE) / CAST(tm AS DOUBLE) * 100, 2) AS pct_revenue
FROM g CROSS JOIN t
"""

SQL["vip_list"] = _RFM + """,
q AS (SELECT quantile_cont(CAST(monetary AS DOUBLE), 0.95) AS q95 FROM rfm),
c AS (SELECT rfm.* FROM rfm CROSS JOIN q
      WHERE segment IN ('Champions', 'Loyal Customers', 'Potential Loyalists')
         OR CAST(monetary AS DOUBLE) >= q95),
top AS (SELECT *, row_number() OVER (ORDER BY monetary DESC, customer_key) AS vip_rank
        FROM c QUALIFY vip_rank <= 100),
cu AS (SELECT c_custkey, min(c_acctbal) AS c_acctbal, min(c_mktsegment) AS c_mktsegment,
              min(c_nationkey) AS c_nationkey
       FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey)
SELECT top.customer_key, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
       r_score, f_score, m_score, rfm_score, rfm_total, segment,
       CAST(vip_rank AS BIGINT) AS vip_rank, cu.c_acctbal, cu.c_mktsegment, cu.c_nationkey,
       CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 'below 0'
            WHEN c_acctbal > 0 AND c_acctbal <= 2000 THEN '0-2k'
            WHEN c_acctbal > 2000 AND c_acctbal <= 4000 THEN '2k-4k'
            WHEN c_acctbal > 4000 AND c_acctbal <= 6000 THEN '4k-6k'
            WHEN c_acctbal > 6000 AND c_acctbal <= 8000 THEN '6k-8k'
            WHEN c_acctbal > 8000 AND c_acctbal <= 10000 THEN '8k-10k' END AS age_group,
       CASE WHEN rfm_total >= 14 THEN 'Platinum' WHEN rfm_total >= 11 THEN 'Gold'
            WHEN rfm_total >= 8 THEN 'Silver' ELSE 'Bronze' END AS vip_tier
FROM top LEFT JOIN cu ON cu.c_custkey = top.customer_key
"""

_COHORT = """
WITH o AS (
  SELECT o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS flag
  FROM orders WHERE o_orderdate IS NOT NULL AND o_custkey IS NOT NULL),
f AS (SELECT customer_key, min(d) AS first_date FROM o GROUP BY customer_key),
co AS (
  SELECT o.customer_key, o.flag, strftime(f.first_date, '%Y-%m') AS cohort_month,
         CAST((year(o.d) - year(f.first_date)) * 12 + (month(o.d) - month(f.first_date)) + 1 AS BIGINT) AS cohort_index
  FROM o JOIN f USING (customer_key)),
cells AS (SELECT cohort_month, cohort_index, count(DISTINCT customer_key) AS customers
          FROM co GROUP BY ALL),
size AS (SELECT cohort_month, customers AS cohort_size FROM cells WHERE cohort_index = 1),
ret AS (
  SELECT cells.*, size.cohort_size,
         round(CAST(customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 6) AS retention_pct
  FROM cells LEFT JOIN size USING (cohort_month)),
ren AS (SELECT cohort_month, cohort_index, count(DISTINCT customer_key) AS renewals
        FROM co WHERE flag = 'P' GROUP BY ALL),
grid AS (SELECT s.cohort_month, s.cohort_size, i.cohort_index
         FROM size s CROSS JOIN (SELECT DISTINCT cohort_index FROM ret) i),
renf AS (
  SELECT g.cohort_month, g.cohort_index, g.cohort_size,
         CASE WHEN r.renewals IS NOT NULL THEN r.renewals
              WHEN g.cohort_month NOT IN (SELECT cohort_month FROM ren)
                OR g.cohort_index NOT IN (SELECT cohort_index FROM ren) THEN 0 END AS renewals
  FROM grid g LEFT JOIN ren r USING (cohort_month, cohort_index)),
renr AS (
  SELECT cohort_month, cohort_index, renewals, cohort_size,
         round(CAST(renewals AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100, 6) AS renewal_pct
  FROM renf WHERE renewals IS NOT NULL)"""

SQL["cohort_retention"] = _COHORT + """
SELECT cohort_month, cohort_index, customers, cohort_size, retention_pct FROM ret
"""

SQL["cohort_renewal"] = _COHORT + """
SELECT cohort_month, cohort_index, renewals, cohort_size, renewal_pct FROM renr
"""

SQL["cohort_matrix"] = _COHORT + """,
firsts AS (SELECT DISTINCT cohort_month FROM ret ORDER BY cohort_month LIMIT 10)
SELECT cohort_month,
""" + ",\n".join(
    f"  max(CASE WHEN cohort_index = {i} THEN retention_pct END) AS m{i}" for i in range(1, 13)
) + """
FROM ret WHERE cohort_month IN (SELECT cohort_month FROM firsts) GROUP BY cohort_month
"""

SQL["cohort_rate_means"] = _COHORT + """
SELECT (SELECT round(avg(CAST(customers AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100), 6) FROM ret WHERE cohort_index = 2) AS avg_retention_idx2,
       (SELECT round(avg(CAST(renewals AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100), 6) FROM renr WHERE cohort_index = 2) AS avg_renewal_idx2,
       (SELECT round(avg(CAST(renewals AS DOUBLE) / CAST(cohort_size AS DOUBLE) * 100), 6) FROM renr WHERE cohort_index = 13) AS avg_renewal_idx13
"""

_REV = """
WITH rev AS (
  SELECT o_custkey AS customer_key, coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS revenue
  FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
tot AS (SELECT sum(revenue) AS total, count(*) AS n FROM rev),
run AS (
  SELECT customer_key, revenue,
         row_number() OVER (ORDER BY revenue DESC, customer_key) AS rnk,
         sum(revenue) OVER (ORDER BY revenue DESC, customer_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM rev)"""

SQL["pareto_top"] = _REV + """
SELECT CAST(rnk AS BIGINT) AS rank, customer_key, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) * 100, 6) AS cumulative_pct
FROM run CROSS JOIN tot WHERE rnk <= 20
"""

SQL["pareto_80"] = _REV + """
SELECT n AS total_customers, CAST(total AS DOUBLE) AS total_revenue,
       (SELECT count(*) FROM run WHERE cum <= total * 0.8) + 1 AS customers_for_share,
       round(CAST((SELECT count(*) FROM run WHERE cum <= total * 0.8) + 1 AS DOUBLE) / CAST(n AS DOUBLE) * 100, 6) AS pct_customers_for_share
FROM tot
"""

_FACTS = """
WITH lo AS (
  SELECT l_orderkey AS ok, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS volume,
         sum(l_quantity) AS duration
  FROM lineitem GROUP BY l_orderkey),
facts AS (
  SELECT o_custkey AS customer_key, o_orderkey AS ok, CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS margin, o_orderpriority AS company,
         coalesce(lo.volume, 0) AS volume, lo.duration
  FROM orders LEFT JOIN lo ON lo.ok = o_orderkey WHERE o_custkey IS NOT NULL),
cu AS (SELECT c_custkey, min(c_name) AS c_name, min(c_nationkey) AS c_nationkey,
              min(c_acctbal) AS c_acctbal, min(c_mktsegment) AS c_mktsegment
       FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey),
vm AS (
  SELECT p.customer_key, CAST(sm AS DOUBLE) AS total_margin, CAST(sv AS DOUBLE) AS total_volume,
         order_count, company,
         round(CAST(sm AS DOUBLE) / CAST(order_count AS DOUBLE), 6) AS avg_margin,
         round(CAST(sv AS DOUBLE) / CAST(order_count AS DOUBLE), 6) AS avg_volume,
         cu.c_mktsegment, cu.c_acctbal, cu.c_nationkey
  FROM (SELECT customer_key, sum(margin) AS sm, sum(volume) AS sv, count(ok) AS order_count,
               arg_max(company, (order_date, ok)) FILTER (WHERE company IS NOT NULL) AS company
        FROM facts GROUP BY customer_key) p
  LEFT JOIN cu ON cu.c_custkey = p.customer_key)"""

SQL["volume_margin"] = _FACTS + """
SELECT * FROM vm
"""

SQL["volume_margin_corr"] = _FACTS + """
SELECT count(*) AS n_customers, round(corr(total_volume, total_margin), 6) AS corr_volume_margin FROM vm
"""

SQL["volume_margin_tiers"] = _FACTS + """
SELECT c_mktsegment,
       round_even(CAST(sum(CAST(total_volume AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(customer_key) AS DOUBLE), 0) AS avg_volume,
       round_even(CAST(sum(CAST(total_margin AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(customer_key) AS DOUBLE), 0) AS avg_margin,
       round_even(CAST(sum(order_count) AS DOUBLE) / CAST(count(customer_key) AS DOUBLE), 0) AS avg_orders,
       count(customer_key) AS count
FROM vm WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
"""

_FEATURES = _RFM + "," + _FACTS.replace("WITH lo AS", "lo AS", 1) + """,
fa AS (
  SELECT customer_key, count(ok) AS order_count, CAST(sum(margin) AS DOUBLE) AS margin_sum,
         round(CAST(sum(margin) AS DOUBLE) / CAST(count(ok) AS DOUBLE), 6) AS margin_mean,
         round(stddev_samp(CAST(margin AS DOUBLE)), 6) AS margin_std,
         CAST(sum(volume) AS DOUBLE) AS volume_sum,
         round(CAST(sum(volume) AS DOUBLE) / CAST(count(ok) AS DOUBLE), 6) AS volume_mean,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date,
         round(CAST(sum(duration) AS DOUBLE) / CAST(count(duration) AS DOUBLE), 6) AS duration_mean,
         arg_max(company, (order_date, ok)) FILTER (WHERE company IS NOT NULL) AS last_company
  FROM facts GROUP BY customer_key),
dc AS (
  SELECT o_custkey AS customer_key, count(DISTINCT l_partkey) AS n_products,
         count(DISTINCT l_suppkey) AS n_channels, count(DISTINCT l_suppkey) AS n_employees
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
gl AS (SELECT max(CAST(o_orderdate AS DATE)) AS gl FROM orders),
ft0 AS (
  SELECT rfm.customer_key, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
         r_score, f_score, m_score, rfm_score, rfm_total, segment,
         cu.c_name, cu.c_nationkey, cu.c_acctbal, cu.c_mktsegment,
         fa.order_count, fa.margin_sum, fa.margin_mean, fa.margin_std, fa.volume_sum, fa.volume_mean,
         fa.first_order_date, fa.last_order_date, fa.duration_mean, fa.last_company,
         dc.n_products, dc.n_channels, dc.n_employees,
         CAST(date_diff('day', fa.first_order_date, fa.last_order_date) AS BIGINT) AS customer_tenure_days,
         CAST(date_diff('day', fa.first_order_date, (SELECT gl FROM gl)) AS BIGINT) AS days_since_first_order,
         recency AS days_since_last_order
  FROM rfm LEFT JOIN cu ON cu.c_custkey = rfm.customer_key
  LEFT JOIN fa ON fa.customer_key = rfm.customer_key
  LEFT JOIN dc ON dc.customer_key = rfm.customer_key),
ft AS (
  SELECT customer_key, recency, frequency, monetary, r_score, f_score, m_score, rfm_score, rfm_total,
         segment, c_name, coalesce(c_nationkey, 0) AS c_nationkey, coalesce(c_acctbal, 0) AS c_acctbal,
         c_mktsegment, coalesce(order_count, 0) AS order_count, coalesce(margin_sum, 0) AS margin_sum,
         coalesce(margin_mean, 0) AS margin_mean, coalesce(margin_std, 0) AS margin_std,
         coalesce(volume_sum, 0) AS volume_sum, coalesce(volume_mean, 0) AS volume_mean,
         first_order_date, last_order_date, coalesce(duration_mean, 0) AS duration_mean, last_company,
         coalesce(n_products, 0) AS n_products, coalesce(n_channels, 0) AS n_channels, coalesce(n_employees, 0) AS n_employees,
         coalesce(customer_tenure_days, 0) AS customer_tenure_days,
         coalesce(days_since_first_order, 0) AS days_since_first_order, days_since_last_order
  FROM ft0)"""

SQL["customer_features"] = _FEATURES + """
SELECT * FROM ft
"""

SQL["feature_summary"] = _FEATURES + """
SELECT count(*) AS n_customers, CAST(30 AS BIGINT) AS n_features,
       round(avg(order_count), 6) AS avg_orders, round(avg(customer_tenure_days), 6) AS avg_tenure_days,
       round(avg(n_products), 6) AS avg_products,
       min(recency) AS min_recency, max(recency) AS max_recency, round(avg(recency), 6) AS mean_recency,
       min(frequency) AS min_frequency, max(frequency) AS max_frequency,
       round(avg(frequency), 6) AS mean_frequency,
       min(monetary) AS min_monetary, max(monetary) AS max_monetary,
       round(CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(monetary) AS DOUBLE), 6) AS mean_monetary
FROM ft
"""


def _case_bins(col: str, edges, labels, ordinal: bool = False) -> str:
    parts = []
    for i, (lo, hi, lab) in enumerate(zip(edges, edges[1:], labels), 1):
        val = str(i) if ordinal else f"'{lab}'"
        top = "" if hi == float("inf") else f" AND {col} <= {hi}"
        parts.append(f"WHEN {col} > {lo}{top} THEN {val}")
    return "CASE " + " ".join(parts) + " END"


def _values_spine(labels) -> str:
    rows = ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(labels, 1))
    return f"(VALUES {rows}) AS spine(bin_order, bin_label)"


from ledgerlens.catalog import (  # noqa: E402
    BALANCE_EDGES, BALANCE_LABELS, SEGMENT_EDGES, SEGMENT_LABELS, TIER_ORDER, HIGH_TIERS)

_HIGH = ", ".join(f"'{t}'" for t in HIGH_TIERS)

SQL["customer_basic_stats"] = """
SELECT count(*) AS n_customers, count(DISTINCT c_acctbal) AS n_distinct_c_acctbal,
       count(DISTINCT c_nationkey) AS n_distinct_c_nationkey,
       count(DISTINCT c_mktsegment) AS n_distinct_c_mktsegment,
       CAST(min(c_acctbal) AS DOUBLE) AS min_c_acctbal, CAST(max(c_acctbal) AS DOUBLE) AS max_c_acctbal,
       round(CAST(sum(CAST(c_acctbal AS DECIMAL(38,6))) AS DOUBLE) / CAST(count(c_acctbal) AS DOUBLE), 6) AS mean_c_acctbal,
       round(median(c_acctbal), 6) AS median_c_acctbal,
       round(stddev_samp(c_acctbal), 6) AS std_c_acctbal,
       count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS n_flagged,
       (SELECT c_nationkey FROM customer WHERE c_nationkey IS NOT NULL
        GROUP BY c_nationkey ORDER BY count(*) DESC, c_nationkey LIMIT 1) AS mode_c_nationkey,
       (SELECT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL
        GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1) AS mode_c_mktsegment
FROM customer
"""

SQL["balance_describe"] = """
SELECT count(c_acctbal) AS count,
       round(CAST(sum(CAST(c_acctbal AS DECIMAL(38,6))) AS DOUBLE) / CAST(count(c_acctbal) AS DOUBLE), 6) AS mean,
       round(stddev_samp(c_acctbal), 6) AS std, CAST(min(c_acctbal) AS DOUBLE) AS min,
       round(quantile_cont(c_acctbal, 0.25), 6) AS p25, round(quantile_cont(c_acctbal, 0.5), 6) AS p50,
       round(quantile_cont(c_acctbal, 0.75), 6) AS p75, CAST(max(c_acctbal) AS DOUBLE) AS max
FROM customer
"""

SQL["segment_distribution"] = f"""
SELECT c_mktsegment, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM customer) AS DOUBLE) * 100, 6) AS pct,
       CAST(CASE c_mktsegment {" ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TIER_ORDER, 1))} END AS BIGINT) AS display_order
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
"""

SQL["tier_level_labels"] = f"""
SELECT c_custkey, c_mktsegment,
       CASE WHEN c_mktsegment IN ({_HIGH}) THEN 'High' ELSE 'Low' END AS tier_level
FROM customer
"""

SQL["balance_bins"] = f"""
WITH b AS (SELECT c_acctbal, {_case_bins('c_acctbal', BALANCE_EDGES, BALANCE_LABELS, True)} AS bin_order
           FROM customer),
g AS (SELECT bin_order, count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(38,6))) AS s,
             stddev_samp(c_acctbal) AS sd FROM b WHERE bin_order IS NOT NULL GROUP BY bin_order),
t AS (SELECT sum(n) AS t FROM g)
SELECT CAST(spine.bin_order AS INTEGER) AS bin_order, spine.bin_label, coalesce(g.n, 0) AS n,
       round(CAST(coalesce(g.n, 0) AS DOUBLE) / CAST(t.t AS DOUBLE) * 100, 6) AS pct,
       round(CAST(g.s AS DOUBLE) / CAST(g.n AS DOUBLE), 6) AS mean_c_acctbal,
       round(g.sd, 6) AS std_c_acctbal
FROM {_values_spine(BALANCE_LABELS)} LEFT JOIN g USING (bin_order) CROSS JOIN t
"""

_CUST_NATION = """
WITH nat AS (SELECT n_nationkey, min(n_name) AS n_name FROM nation WHERE n_nationkey IS NOT NULL GROUP BY n_nationkey),
c AS (SELECT customer.*, nat.n_name FROM customer LEFT JOIN nat ON nat.n_nationkey = c_nationkey)"""

SQL["crosstab_counts"] = _CUST_NATION + """,
cnt AS (SELECT n_name, c_mktsegment, count(*) AS n FROM c
        WHERE n_name IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY ALL),
top AS (SELECT n_name FROM c WHERE n_name IS NOT NULL GROUP BY n_name ORDER BY count(*) DESC, n_name LIMIT 10),
grid AS (SELECT r.n_name, s.c_mktsegment FROM (SELECT DISTINCT n_name FROM cnt) r
         CROSS JOIN (SELECT DISTINCT c_mktsegment FROM cnt) s)
SELECT grid.n_name, grid.c_mktsegment, coalesce(cnt.n, 0) AS n
FROM grid LEFT JOIN cnt USING (n_name, c_mktsegment) WHERE grid.n_name IN (SELECT n_name FROM top)
"""

SQL["crosstab_rowpct"] = f"""
WITH b AS (SELECT {_case_bins('c_acctbal', BALANCE_EDGES, BALANCE_LABELS)} AS bin_label, c_mktsegment FROM customer),
cnt AS (SELECT bin_label, c_mktsegment, count(*) AS n FROM b
        WHERE bin_label IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY ALL),
grid AS (SELECT r.bin_label, s.c_mktsegment FROM (SELECT DISTINCT bin_label FROM cnt) r
         CROSS JOIN (SELECT DISTINCT c_mktsegment FROM cnt) s),
full_ AS (SELECT grid.*, coalesce(cnt.n, 0) AS n FROM grid LEFT JOIN cnt USING (bin_label, c_mktsegment))
SELECT bin_label, c_mktsegment,
       round(CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY bin_label) AS DOUBLE) * 100, 6) AS pct
FROM full_
"""

SQL["crosstab_margins"] = f"""
WITH b AS (SELECT {_case_bins('c_acctbal', SEGMENT_EDGES, SEGMENT_LABELS)} AS bin_label,
                  CASE WHEN c_mktsegment IN ({_HIGH}) THEN 'High' ELSE 'Low' END AS tier_level
           FROM customer),
clean AS (SELECT * FROM b WHERE bin_label IS NOT NULL AND tier_level IS NOT NULL),
cube_ AS (SELECT CASE WHEN grouping(bin_label) = 1 THEN 'All' ELSE bin_label END AS bin_label,
                 CASE WHEN grouping(tier_level) = 1 THEN 'All' ELSE tier_level END AS tier_level,
                 count(*) AS n
          FROM clean GROUP BY CUBE (bin_label, tier_level)),
grid AS (SELECT r.bin_label, s.tier_level FROM (SELECT DISTINCT bin_label FROM cube_) r
         CROSS JOIN (SELECT DISTINCT tier_level FROM cube_) s)
SELECT grid.bin_label, grid.tier_level, coalesce(cube_.n, 0) AS n
FROM grid LEFT JOIN cube_ USING (bin_label, tier_level)
"""

SQL["top_bottom_occupations"] = _CUST_NATION + """,
vc AS (SELECT n_name, count(*) AS n,
              round(CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM customer) AS DOUBLE) * 100, 6) AS pct
       FROM c WHERE n_name IS NOT NULL GROUP BY n_name),
pos AS (SELECT *, row_number() OVER (ORDER BY n DESC, n_name) AS p, count(*) OVER () AS cnt FROM vc)
SELECT n_name, n, pct, CAST(p AS BIGINT) AS rank, 'top' AS position FROM pos WHERE p <= 10
UNION ALL
SELECT n_name, n, pct, CAST(cnt - p + 1 AS BIGINT) AS rank, 'bottom' AS position FROM pos WHERE p > cnt - 5
"""

SQL["orders_per_customer_dist"] = """
SELECT orders_per_customer, count(*) AS n_customers
FROM (SELECT o_custkey, count(*) AS orders_per_customer FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
GROUP BY orders_per_customer
"""

SQL["orders_per_customer_stats"] = """
WITH per AS (SELECT o_custkey, count(*) AS k FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT count(*) AS n_customers, min(k) AS min_orders, max(k) AS max_orders,
       round(avg(k), 6) AS mean_orders, round(median(k), 6) AS median_orders,
       count(*) FILTER (WHERE k > 1) AS n_repeat_customers
FROM per
"""

SQL["order_type_share"] = """
SELECT o_orderpriority, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 6) AS pct,
       CAST(min(o_orderdate) AS DATE) AS first_order_date, CAST(max(o_orderdate) AS DATE) AS last_order_date
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
"""

SQL["monthly_series"] = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       count(DISTINCT o_custkey) AS n_customers
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL
"""

_EMP = """
WITH nat AS (SELECT n_nationkey, min(n_name) AS n_name, min(n_regionkey) AS n_regionkey
             FROM nation WHERE n_nationkey IS NOT NULL GROUP BY n_nationkey),
reg AS (SELECT r_regionkey, min(r_name) AS r_name FROM region WHERE r_regionkey IS NOT NULL GROUP BY r_regionkey),
emp AS (SELECT s_suppkey, min(s_nationkey) AS branch_key, min(nat.n_name) AS branch, min(reg.r_name) AS company
        FROM supplier LEFT JOIN nat ON nat.n_nationkey = s_nationkey
        LEFT JOIN reg ON reg.r_regionkey = nat.n_regionkey
        WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey),
tot AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s, count(l_orderkey) AS c,
               count(l_extendedprice) AS vals
        FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey),
j AS (SELECT tot.*, emp.branch_key, emp.branch, emp.company FROM tot LEFT JOIN emp ON emp.s_suppkey = tot.l_suppkey)"""

SQL["revenue_by_company"] = _EMP + """
SELECT company, CAST(sum(s) AS DOUBLE) AS revenue, CAST(sum(c) AS BIGINT) AS n,
       round(CAST(sum(s) AS DOUBLE) / CAST(sum(vals) AS DOUBLE), 6) AS avg_revenue
FROM j WHERE company IS NOT NULL GROUP BY company
"""

SQL["channel_type_share"] = _EMP + """
SELECT branch AS channel_type, CAST(sum(s) AS DOUBLE) AS revenue, CAST(sum(c) AS BIGINT) AS n,
       round(CAST(sum(s) AS DOUBLE) / sum(CAST(sum(s) AS DOUBLE)) OVER () * 100, 6) AS share_pct
FROM j WHERE branch IS NOT NULL GROUP BY branch
"""

SQL["company_comparison"] = _EMP + """
SELECT company, CAST(sum(s) AS DOUBLE) AS revenue, CAST(sum(c) AS BIGINT) AS n, count(*) AS n_employees,
       round(CAST(sum(s) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS revenue_per_employee
FROM j WHERE company IS NOT NULL GROUP BY company
"""

SQL["branch_performance"] = _EMP + """,
g AS (SELECT branch_key, CAST(sum(s) AS DOUBLE) AS revenue, CAST(sum(c) AS BIGINT) AS n
      FROM j WHERE branch_key IS NOT NULL GROUP BY branch_key),
t AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, branch_key) AS rank FROM g QUALIFY rank <= 10)
SELECT t.branch_key, t.revenue, t.n, CAST(t.rank AS BIGINT) AS rank, coalesce(nat.n_name, 'Unknown') AS n_name
FROM t LEFT JOIN nat ON nat.n_nationkey = t.branch_key
"""

SQL["employee_stats"] = """
WITH per AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue, count(l_orderkey) AS contracts
             FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey),
r AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, l_suppkey) AS rk, count(*) OVER () AS n FROM per),
tot AS (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem)
SELECT (SELECT count(*) FROM per) AS n_employees,
       (SELECT round(CAST(sum(revenue) AS DOUBLE) / CAST(count(revenue) AS DOUBLE), 6) FROM per) AS avg_revenue,
       (SELECT round(median(contracts), 6) FROM per) AS median_contracts,
       round(CAST((SELECT coalesce(sum(revenue), 0) FROM r WHERE rk <= floor(n * 0.1)) AS DOUBLE)
             / CAST((SELECT total FROM tot) AS DOUBLE) * 100, 6) AS top10pct_share
"""

SQL["kpi_by_type"] = """
SELECT event_type, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       count(DISTINCT user_id) AS n_users,
       CAST(min(date_trunc('month', ts)) AS DATE) AS first_month,
       CAST(max(date_trunc('month', ts)) AS DATE) AS last_month
FROM events WHERE event_type IS NOT NULL GROUP BY event_type
"""

SQL["prefix_lookup"] = SQL["top_channels_by_revenue"].replace(
    "SELECT t.channel_key,", "SELECT t.channel_key AS ck,", 1).join(["WITH top_ AS (", ")"]) + """,
codes AS (SELECT s_suppkey, min(s_name) AS code FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey),
base AS (SELECT substr(s_name, 1, 16) AS base_code, count(*) AS base_size, min(s_suppkey) AS base_key
         FROM supplier GROUP BY ALL)
SELECT top_.ck AS channel_key, top_.revenue, top_.n, top_.name, top_.rank, codes.code,
       substr(codes.code, 1, 16) AS base_code, base.base_size, base.base_key
FROM top_ LEFT JOIN codes ON codes.s_suppkey = top_.ck
LEFT JOIN base ON base.base_code = substr(codes.code, 1, 16)
"""

from ledgerlens.catalog import PRICE_EDGES, PRICE_LABELS, ECONOMY_BELOW, LUXURY_FROM  # noqa: E402

SQL["part_price_describe"] = """
SELECT count(p_retailprice) AS count,
       round(CAST(sum(CAST(p_retailprice AS DECIMAL(38,6))) AS DOUBLE) / CAST(count(p_retailprice) AS DOUBLE), 6) AS mean,
       round(stddev_samp(p_retailprice), 6) AS std, CAST(min(p_retailprice) AS DOUBLE) AS min,
       round(quantile_cont(p_retailprice, 0.25), 6) AS p25, round(quantile_cont(p_retailprice, 0.5), 6) AS p50,
       round(quantile_cont(p_retailprice, 0.75), 6) AS p75, CAST(max(p_retailprice) AS DOUBLE) AS max,
       count(DISTINCT p_brand) AS n_brands, count(DISTINCT p_partkey) AS n_models
FROM part
"""

_PRICE_STATS = """count(*) AS n,
       round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(p_retailprice) AS DOUBLE), 6) AS avg_price,
       CAST(min(p_retailprice) AS DOUBLE) AS min_price, CAST(max(p_retailprice) AS DOUBLE) AS max_price"""

SQL["brand_stats"] = f"""
SELECT p_brand, {_PRICE_STATS}, count(DISTINCT p_size) AS n_distinct_p_size
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
"""

SQL["size_profile"] = f"""
SELECT p_size, {_PRICE_STATS}, count(DISTINCT p_brand) AS n_distinct_p_brand
FROM part WHERE p_size IS NOT NULL GROUP BY p_size
"""

SQL["price_ranges"] = f"""
WITH g AS (SELECT {_case_bins('p_retailprice', PRICE_EDGES, PRICE_LABELS, True)} AS bin_order, count(*) AS n
           FROM part GROUP BY ALL)
SELECT CAST(spine.bin_order AS INTEGER) AS bin_order, spine.bin_label, coalesce(g.n, 0) AS n,
       round(CAST(coalesce(g.n, 0) AS DOUBLE) / CAST((SELECT count(*) FROM part) AS DOUBLE) * 100, 6) AS pct
FROM {_values_spine(PRICE_LABELS)} LEFT JOIN g ON g.bin_order = spine.bin_order
"""

SQL["economy_parts"] = f"""
SELECT p_partkey, p_name, p_brand, p_retailprice,
       CAST(row_number() OVER (ORDER BY p_retailprice, p_partkey) AS BIGINT) AS rank
FROM part WHERE p_retailprice < {ECONOMY_BELOW} QUALIFY rank <= 10
"""

SQL["luxury_parts"] = f"""
SELECT p_partkey, p_name, p_brand, p_retailprice,
       CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS BIGINT) AS rank,
       (SELECT count(*) FROM part WHERE p_retailprice >= {LUXURY_FROM}) AS n_luxury
FROM part WHERE p_retailprice >= {LUXURY_FROM} QUALIFY rank <= 10
"""

SQL["vehicle_category"] = f"""
SELECT CASE WHEN p_size = 2 THEN '2-wheel' WHEN p_size >= 4 THEN '4-wheel' ELSE 'Other' END AS category,
       {_PRICE_STATS}
FROM part GROUP BY ALL
"""

SQL["model_name_counts"] = """
SELECT p_name, count(*) AS n, (SELECT count(DISTINCT p_name) FROM part) AS n_distinct_names
FROM part WHERE p_name IS NOT NULL GROUP BY p_name
"""

SQL["product_sales"] = """
WITH g AS (SELECT l_partkey AS product_key, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev, count(l_orderkey) AS n
           FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey),
p AS (SELECT *, row_number() OVER (ORDER BY CAST(rev AS DOUBLE) DESC, product_key) AS pos, count(*) OVER () AS cnt FROM g),
sel AS (SELECT product_key, rev, n, pos AS rank, 'top' AS position FROM p WHERE pos <= 15
        UNION ALL
        SELECT product_key, rev, n, cnt - pos + 1 AS rank, 'bottom' AS position FROM p WHERE pos > cnt - 10),
d AS (SELECT p_partkey, min(p_name) AS p_name FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey)
SELECT product_key, CAST(rev AS DOUBLE) AS revenue, n, coalesce(substr(d.p_name, 1, 40), 'Unknown') AS name,
       CAST(rank AS BIGINT) AS rank, position
FROM sel LEFT JOIN d ON d.p_partkey = sel.product_key
"""

SQL["product_channel_combo"] = """
WITH g AS (SELECT l_partkey, l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
                  count(l_orderkey) AS n
           FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL GROUP BY ALL),
t AS (SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC, l_partkey, l_suppkey) AS BIGINT) AS rank
      FROM g QUALIFY rank <= 10),
pn AS (SELECT p_partkey, min(p_name) AS p_name FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey),
sn AS (SELECT s_suppkey, min(s_name) AS s_name FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey)
SELECT t.*, substr(coalesce(pn.p_name, 'Unknown'), 1, 50) AS p_name, substr(coalesce(sn.s_name, 'Unknown'), 1, 50) AS s_name
FROM t LEFT JOIN pn ON pn.p_partkey = t.l_partkey LEFT JOIN sn ON sn.s_suppkey = t.l_suppkey
"""

SQL["duration_stats"] = """
SELECT l_quantity, count(*) AS n,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(l_extendedprice) AS DOUBLE), 6) AS mean_price,
       round(median(l_extendedprice), 6) AS median_price, round(stddev_samp(l_extendedprice), 6) AS std_price,
       round(CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) * 100, 6) AS pct
FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_quantity
"""

SQL["word_extract"] = """
SELECT nullif(regexp_extract(p_name, '([\\p{L}\\p{N}_]+)', 1), '') AS first_word, count(*) AS n,
       count(*) FILTER (WHERE coalesce(contains(p_name, 'ring'), false)) AS n_contains,
       count(*) FILTER (WHERE coalesce(starts_with(p_name, 'red'), false)) AS n_prefix
FROM part WHERE nullif(regexp_extract(p_name, '([\\p{L}\\p{N}_]+)', 1), '') IS NOT NULL GROUP BY ALL
"""

SQL["priority_suffix"] = """
WITH s AS (SELECT nullif(regexp_extract(o_orderpriority, '-([\\p{L}\\p{N}_]+)$', 1), '') AS suffix FROM orders)
SELECT suffix, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 6) AS pct
FROM s WHERE suffix IS NOT NULL GROUP BY suffix
"""

SQL["hierarchy_counts"] = """
SELECT 'region_nations' AS level, CAST(r_regionkey AS BIGINT) AS parent_key, r_name AS parent_name,
       count(n_nationkey) AS n_children
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL
UNION ALL
SELECT 'nation_suppliers', CAST(n_nationkey AS BIGINT), n_name, count(s_suppkey)
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL
UNION ALL
SELECT 'nation_customers', CAST(n_nationkey AS BIGINT), n_name, count(c_custkey)
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL
"""

SQL["dimension_listing"] = """
WITH reg AS (SELECT r_regionkey, min(r_name) AS r_name FROM region WHERE r_regionkey IS NOT NULL GROUP BY r_regionkey)
SELECT n_nationkey, n_name, n_regionkey, reg.r_name FROM nation LEFT JOIN reg ON reg.r_regionkey = n_regionkey
"""

# Driver table columns in file order.
_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


def _missing_sum(cols) -> str:
    return " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)


SQL["table_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_columns, "
    f"CAST(coalesce(sum({_missing_sum(cols)}), 0) AS BIGINT) AS n_missing, "
    f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS n_duplicates FROM {t}"
    for t, cols in _COLUMNS.items())

# Type family of every driver column, in the same order.
_TYPES = {
    "region": ["integer", "string"],
    "nation": ["integer", "string", "integer"],
    "customer": ["integer", "string", "integer", "float", "string"],
    "supplier": ["integer", "string", "integer", "float"],
    "part": ["integer", "string", "string", "string", "integer", "float"],
    "orders": ["integer", "integer", "string", "float", "datetime", "string"],
    "lineitem": ["integer", "integer", "integer", "integer", "float", "float", "float", "float",
                 "string", "string", "datetime"],
    "events": ["integer", "datetime", "integer", "string", "float", "string"],
}

SQL["column_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST({i} AS BIGINT) AS position, '{c}' AS column_name, "
    f"'{_TYPES[t][i - 1]}' AS data_type, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) AS n_rows FROM {t}"
    for t, cols in _COLUMNS.items() for i, c in enumerate(cols, 1))

_NA = ", ".join("'" + tok.replace("'", "''") + "'" for tok in
                ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
                 "4-NOT SPECIFIED"])


def _issues(name, source, cols):
    nulls = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, 'missing' AS issue, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS n FROM {source}" for c in cols)
    dups = (f"SELECT '{name}', 'duplicate_rows', CAST(NULL AS VARCHAR), "
            f"(SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))")
    return f"SELECT * FROM ({nulls}\nUNION ALL\n{dups}) WHERE n > 0"


_CLEAN_ORDERS = ("(SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus IN (" + _NA + ") THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
                 "o_totalprice, o_orderdate, CASE WHEN o_orderpriority IN (" + _NA + ") THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders)")
SQL["quality_issues"] = "\nUNION ALL\n".join(
    [_issues(t, _CLEAN_ORDERS if t == "orders" else t, cols) for t, cols in _COLUMNS.items()]
    + [_issues("customer_segments", "(SELECT c_nationkey, c_mktsegment FROM customer)",
               ["c_nationkey", "c_mktsegment"])])


def _orphans(check, child, ck, parent, pk):
    return f"""SELECT '{check}' AS check_name, count({ck}) AS n_child_keys,
       count(*) FILTER (WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)) AS n_orphan_keys,
       count(*) FILTER (WHERE {ck} IS NULL) AS n_null_keys
FROM (SELECT DISTINCT {ck} FROM {child})"""


SQL["referential_orphans"] = "\nUNION ALL\n".join([
    _orphans("orders->customer", "orders", "o_custkey", "customer", "c_custkey"),
    _orphans("lineitem->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphans("lineitem->part", "lineitem", "l_partkey", "part", "p_partkey"),
    _orphans("lineitem->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
])

SQL["executive_summary"] = f"""
WITH o AS (
  SELECT count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS rev,
         sum(CASE WHEN coalesce(starts_with(o_orderpriority, '1'), false) THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS direct,
         count(o_totalprice) AS n_price,
         coalesce(strftime(min(CAST(o_orderdate AS DATE)), '%Y-%m-%d'), 'N/A') AS first_order_date,
         coalesce(strftime(max(CAST(o_orderdate AS DATE)), '%Y-%m-%d'), 'N/A') AS last_order_date,
         count(DISTINCT date_trunc('month', o_orderdate)) AS active_months,
         quantile_cont(o_totalprice, 0.5) AS med
  FROM orders),
c AS (SELECT count(*) AS n_customers, count(*) FILTER (WHERE c_mktsegment IN ({_HIGH})) AS n_high_tier FROM customer)
SELECT (SELECT count(*) FROM region) AS n_region, (SELECT count(*) FROM nation) AS n_nation,
       (SELECT count(*) FROM supplier) AS n_supplier, (SELECT count(*) FROM part) AS n_part,
       c.n_customers, o.n_orders, (SELECT count(*) FROM lineitem) AS n_order_lines,
       CAST(coalesce(o.rev, 0) AS DOUBLE) AS total_revenue,
       round(CAST(coalesce(o.rev, 0) AS DOUBLE) / 1e9, 6) AS total_revenue_bn,
       round(CAST(o.rev AS DOUBLE) / CAST(o.n_price AS DOUBLE), 6) AS avg_order_value,
       round(o.med, 6) AS median_order_value,
       o.first_order_date, o.last_order_date, o.active_months, c.n_high_tier,
       round(CAST(c.n_high_tier AS DOUBLE) / CAST(c.n_customers AS DOUBLE) * 100, 6) AS high_tier_pct,
       round(CAST(coalesce(o.direct, 0) AS DOUBLE) / CAST(o.rev AS DOUBLE) * 100, 6) AS direct_share_pct,
       (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_orders_with_lines,
       (SELECT count(DISTINCT p_brand) FROM part) AS n_brands
FROM o CROSS JOIN c
"""

SQL["clean_orders"] = """
WITH raw AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text,
         CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'n/a'
              ELSE printf('%.2f', o_totalprice) END AS price_text
  FROM orders),
p AS (SELECT *, CAST(try_strptime(trim(date_text), '%Y-%m-%d') AS DATE) AS d FROM raw)
SELECT o_orderkey, o_custkey, d AS order_date, CAST(date_trunc('month', d) AS DATE) AS order_month,
       CAST(year(d) AS INTEGER) AS order_year, CAST(month(d) AS INTEGER) AS order_month_num,
       CAST(coalesce(TRY_CAST(price_text AS DECIMAL(18,2)), 0) AS DOUBLE) AS price
FROM p
"""

SQL["csv_roundtrip"] = "SELECT * FROM orders"

SQL["cohort_matrix_csv"] = _COHORT + """
SELECT cohort_month, cohort_index, retention_pct FROM ret
"""

SQL["vip_tier_counts"] = SQL["vip_list"].rstrip().rsplit("SELECT top.customer_key", 1)[0] + """
SELECT vip_tier, count(*) AS n,
       CAST(CASE vip_tier WHEN 'Platinum' THEN 1 WHEN 'Gold' THEN 2 WHEN 'Silver' THEN 3
                          WHEN 'Bronze' THEN 4 END AS BIGINT) AS display_order
FROM (SELECT CASE WHEN rfm_total >= 14 THEN 'Platinum' WHEN rfm_total >= 11 THEN 'Gold'
                  WHEN rfm_total >= 8 THEN 'Silver' ELSE 'Bronze' END AS vip_tier FROM top)
GROUP BY vip_tier
"""

SQL["renewal_matrix"] = _COHORT + """,
firsts AS (SELECT DISTINCT cohort_month FROM renr ORDER BY cohort_month LIMIT 15)
SELECT cohort_month,
""" + ",\n".join(
    f"  max(CASE WHEN cohort_index = {i} THEN renewal_pct END) AS m{i}" for i in range(1, 13)
) + """
FROM renr WHERE cohort_month IN (SELECT cohort_month FROM firsts) GROUP BY cohort_month
"""

SQL["scatter_axis_limits"] = _FACTS + """
SELECT round(quantile_cont(CAST(CAST(total_volume AS DECIMAL(18,2)) AS DOUBLE), 0.95), 6) AS volume_p95,
       round(quantile_cont(CAST(CAST(total_margin AS DECIMAL(18,2)) AS DOUBLE), 0.95), 6) AS margin_p95
FROM vm
"""

def _summed(dataset: str, query: str, numbers: list[str], others: list[str]) -> str:
    cells = " + ".join(f"count({c})" for c in numbers + others)
    total = " + ".join(f"coalesce(sum(CAST({c} AS DECIMAL(38,6))), 0)" for c in numbers)
    chars = " + ".join(f"coalesce(sum(length(CAST({c} AS VARCHAR))), 0)" for c in others) or "0"
    return (f"SELECT '{dataset}' AS dataset, count(*) AS n_rows, CAST({len(numbers) + len(others)} AS BIGINT) AS n_columns, "
            f"CAST({cells} AS BIGINT) AS n_cells, CAST({total} AS DOUBLE) AS total, CAST({chars} AS BIGINT) AS n_chars "
            f"FROM ({query.strip()})")


def _summed_matrix(dataset: str, query: str, value: str) -> str:
    """Of a matrix of cohorts and months: a row per cohort of the retention matrix, a column per month index."""
    return f"""SELECT '{dataset}', (SELECT count(DISTINCT cohort_month) FROM r{dataset}), (SELECT count(DISTINCT cohort_index) + 1 FROM r{dataset}),
       CAST(count({value}) + (SELECT count(DISTINCT cohort_month) FROM r{dataset}) AS BIGINT),
       CAST(coalesce(sum(CAST({value} AS DECIMAL(38,6))), 0) AS DOUBLE),
       CAST((SELECT 7 * count(DISTINCT cohort_month) FROM r{dataset}) AS BIGINT)
FROM ({query.strip()})"""


_RFM_NUMBERS = ["customer_key", "recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_total"]
_MATRICES = [("cohort_retention_matrix", "cohort_retention", "retention_pct"), ("cohort_pivot", "cohort_retention", "customers"),
             ("renewal_rate_matrix", "cohort_renewal", "renewal_pct"), ("renewal_pivot", "cohort_renewal", "renewals")]

SQL["export_outputs"] = ("WITH " + ",\n".join(f"r{n} AS ({SQL['cohort_retention'].strip()})" for n, _, _ in _MATRICES) + "\n"
                         + "\nUNION ALL\n".join([
    _summed("rfm_segments", SQL["rfm_scores"], _RFM_NUMBERS, ["rfm_score", "segment"]),
    _summed("vip_customers", SQL["vip_list"], [*_RFM_NUMBERS, "vip_rank", "c_acctbal", "c_nationkey"],
            ["rfm_score", "segment", "c_mktsegment", "age_group", "vip_tier"]),
    _summed("pareto_analysis", SQL["pareto_top"], ["rank", "customer_key", "revenue", "cumulative_pct"], []),
    _summed("volume_margin_scatter", SQL["volume_margin"],
            ["customer_key", "total_margin", "total_volume", "order_count", "avg_margin", "avg_volume", "c_acctbal", "c_nationkey"],
            ["company", "c_mktsegment"]),
    _summed("feature_table", SQL["customer_features"],
            [*_RFM_NUMBERS, "c_nationkey", "c_acctbal", "order_count", "margin_sum", "margin_mean", "margin_std", "volume_sum",
             "volume_mean", "duration_mean", "n_products", "n_channels", "n_employees", "customer_tenure_days",
             "days_since_first_order", "days_since_last_order"],
            ["rfm_score", "segment", "c_name", "c_mktsegment", "first_order_date", "last_order_date", "last_company"]),
    *[_summed_matrix(n, SQL[q], v) for n, q, v in _MATRICES]]))

SQL["line_counts_by_part_type"] = """
WITH p AS (SELECT p_partkey, min(p_type) AS p_type FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey)
SELECT coalesce(p_type, 'Unknown') AS part_type, CAST(count(*) AS BIGINT) AS n_lines,
       round(CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) * 100, 6) AS pct
FROM lineitem LEFT JOIN p ON p_partkey = l_partkey GROUP BY 1
"""

SQL["insured_totals"] = """
SELECT count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders FROM lineitem
"""

SQL["top_parts_by_lines"] = """
WITH g AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey),
p AS (SELECT p_partkey, min(p_name) AS p_name FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey),
t AS (SELECT *, row_number() OVER (ORDER BY n_lines DESC, l_partkey) AS rank FROM g)
SELECT rank, l_partkey, coalesce(p_name, 'Unknown') AS p_name, n_lines,
       round(CAST(n_lines AS DOUBLE) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) * 100, 6) AS pct
FROM t LEFT JOIN p ON p_partkey = l_partkey WHERE rank <= 15
"""

_PER_EMPLOYEE = """
WITH per AS (
  SELECT l_suppkey, coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS rev, count(l_extendedprice) AS vals,
         count(l_orderkey) AS n_contracts,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,4)))) AS net
  FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey),
t AS (SELECT *, row_number() OVER (ORDER BY rev DESC, l_suppkey) AS rank FROM per)"""

SQL["employee_top10"] = _PER_EMPLOYEE + """
SELECT rank, l_suppkey, CAST(rev AS DOUBLE) AS revenue, round(CAST(rev AS DOUBLE) / CAST(vals AS DOUBLE), 6) AS avg_revenue,
       n_contracts FROM t WHERE rank <= 10
"""

SQL["employee_top20"] = _PER_EMPLOYEE + """,
s AS (SELECT s_suppkey, min(s_name) AS s_name FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey)
SELECT rank, l_suppkey, coalesce(s_name, 'Unknown') AS s_name, CAST(rev AS DOUBLE) AS revenue,
       CAST(net AS DOUBLE) AS net_revenue, n_contracts
FROM t LEFT JOIN s ON s_suppkey = l_suppkey WHERE rank <= 20
"""

SQL["employee_medians"] = _PER_EMPLOYEE + """
SELECT count(*) AS n_employees, round(quantile_cont(CAST(rev AS DOUBLE), 0.5), 6) AS median_revenue,
       round(avg(n_contracts), 6) AS avg_contracts FROM per
"""

SQL["balance_by_segment"] = """
SELECT c_mktsegment, count(c_acctbal) AS n,
       round(CAST(sum(CAST(c_acctbal AS DECIMAL(38,6))) AS DOUBLE) / CAST(count(c_acctbal) AS DOUBLE), 6) AS avg_balance,
       round(quantile_cont(c_acctbal, 0.5), 6) AS median_balance, round(stddev_samp(c_acctbal), 6) AS std_balance
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
"""

SQL["quantity_describe"] = """
SELECT count(l_quantity) AS count,
       round(CAST(sum(CAST(l_quantity AS DECIMAL(38,6))) AS DOUBLE) / CAST(count(l_quantity) AS DOUBLE), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS std, CAST(min(l_quantity) AS DOUBLE) AS min,
       round(quantile_cont(l_quantity, 0.25), 6) AS p25, round(quantile_cont(l_quantity, 0.5), 6) AS p50,
       round(quantile_cont(l_quantity, 0.75), 6) AS p75, CAST(max(l_quantity) AS DOUBLE) AS max
FROM lineitem
"""


def _kpi(key):
    return f"""SELECT {key}, CAST(coalesce(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)), 0) AS BIGINT) AS contracts,
       CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue
FROM events WHERE {key} IS NOT NULL GROUP BY {key}"""


SQL["kpi_by_channel"] = _kpi("event_type")

SQL["kpi_by_product"] = f"""
WITH k AS ({_kpi("user_id")}),
t AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, user_id) AS rank FROM k),
p AS (SELECT p_partkey, min(p_name) AS p_name FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey)
SELECT rank, user_id, coalesce(p_name, 'Unknown') AS p_name, contracts, revenue
FROM t LEFT JOIN p ON p_partkey = user_id WHERE rank <= 10
"""

SQL["executive_lists"] = _EMP + """,
prod AS (SELECT l_partkey AS k, coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS rev
         FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1),
pn AS (SELECT p_partkey, min(p_name) AS nm FROM part WHERE p_partkey IS NOT NULL GROUP BY 1),
sn AS (SELECT s_suppkey, min(s_name) AS nm FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY 1),
al AS (
  SELECT 'products' AS list, row_number() OVER (ORDER BY rev DESC, k) AS rank, coalesce(nm, 'Unknown') AS name, rev
  FROM prod LEFT JOIN pn ON p_partkey = k
  UNION ALL
  SELECT 'channels', row_number() OVER (ORDER BY sum(s) DESC, branch), branch, sum(s) FROM j WHERE branch IS NOT NULL GROUP BY branch
  UNION ALL
  SELECT 'employees', row_number() OVER (ORDER BY coalesce(s, 0) DESC, l_suppkey), coalesce(nm, 'Unknown'), coalesce(s, 0)
  FROM tot LEFT JOIN sn ON s_suppkey = l_suppkey)
SELECT list, rank, name, CAST(rev AS DOUBLE) AS revenue,
       round(CAST(rev AS DOUBLE) / CAST((SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem) AS DOUBLE) * 100, 6) AS pct
FROM al WHERE rank <= 5
"""

SQL["executive_shares"] = _PER_EMPLOYEE + """
SELECT 'segment_pct' AS figure, c_mktsegment AS name,
       round(CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM customer) AS DOUBLE) * 100, 6) AS value
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
UNION ALL
SELECT 'avg_part_price', NULL, round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(p_retailprice) AS DOUBLE), 6) FROM part
UNION ALL
SELECT 'revenue_per_employee', NULL, round(CAST(sum(rev) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) FROM per
UNION ALL
SELECT 'top_tenth_employees_pct', NULL,
       round(CAST(coalesce(sum(rev) FILTER (WHERE rank <= floor(0.1 * (SELECT count(*) FROM per))), 0) AS DOUBLE) / CAST(sum(rev) AS DOUBLE) * 100, 6) FROM t
"""

SQL["product_listing"] = """
SELECT p_brand, count(p_partkey) AS n_products, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
"""


# ---------------------------------------------------------------- loading: inferred CSV, failing files, bad lines, file order
SQL["csv_inferred_orders"] = """
SELECT o_orderkey AS order_key, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS customer,
       CAST(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS DOUBLE) AS price,
       CAST(o_orderdate AS DATE) AS ordered,
       CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '12 hours 30 minutes'
            ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS placed,
       o_orderpriority = '1-URGENT' AS rush,
       CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'unknown batch' ELSE CAST(o_custkey AS VARCHAR) END AS batch,
       CAST(NULL AS DOUBLE) AS note, o_orderpriority AS priority
FROM orders
"""

SQL["csv_inferred_types"] = """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low FROM orders)
SELECT CAST(position AS INTEGER) AS position, column_name, data_type,
       CASE column_name WHEN 'customer' THEN low WHEN 'note' THEN n ELSE 0 END AS n_missing, n AS n_rows
FROM n, (VALUES (1, 'order_key', 'bigint'), (2, 'customer', 'bigint'), (3, 'price', 'double'), (4, 'ordered', 'date'),
                (5, 'placed', 'timestamp_ntz'), (6, 'rush', 'boolean'), (7, 'batch', 'string'), (8, 'note', 'double'),
                (9, 'priority', 'string')) v(position, column_name, data_type)
"""

SQL["table_load_report"] = "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, 'loaded' AS state, CAST(NULL AS VARCHAR) AS reason, '{f}' AS file_format, count(*) AS n_rows FROM {t}"
     for t, f in (("region", "parquet"), ("nation", "csv"), ("customer", "parquet"), ("orders", "parquet"), ("events", "parquet"))]
    + ["SELECT 'supplier', 'corrupt', 'not readable as parquet', 'parquet', NULL",
       "SELECT 'part', 'corrupt', 'not readable as csv', 'csv', NULL",
       "SELECT 'lineitem', 'absent', 'no such file', NULL, NULL"])

_ORDER_LINES = """
WITH r AS (
  SELECT *, CASE WHEN o_orderpriority = '2-HIGH' THEN 'n/a' ELSE printf('%.2f', o_totalprice) END AS price,
         strftime(o_orderdate, '%Y-%m-%d') AS d, '"' || o_orderpriority || ', ""checked""' AS said,
         CASE WHEN o_orderstatus = 'P' THEN 'too_many_fields'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'open_quote'
              WHEN o_orderpriority = '5-LOW' THEN 'too_few_fields' END AS reason
  FROM orders),
l AS (
  SELECT *, CASE reason
      WHEN 'too_many_fields' THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, price, d, said || '"', 'late')
      WHEN 'open_quote' THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, price, d, said)
      WHEN 'too_few_fields' THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, said || '"') END AS line
  FROM r)
"""

SQL["csv_quarantine"] = _ORDER_LINES + "SELECT reason, line FROM l WHERE reason IS NOT NULL"

SQL["csv_parsed_orders"] = _ORDER_LINES + """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN price = 'n/a' THEN NULL ELSE o_totalprice END AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority || ', "checked"' AS remark
FROM l WHERE reason IS NULL
"""

SQL["csv_quality_report"] = _ORDER_LINES + """
SELECT 'orders_csv' AS table_name, 'missing' AS issue, 'o_totalprice' AS column_name, count(*) AS n
FROM l WHERE reason IS NULL AND price = 'n/a' HAVING count(*) > 0
UNION ALL SELECT 'orders_csv', 'bad_lines:' || reason, NULL, count(*) FROM l WHERE reason IS NOT NULL GROUP BY reason
"""

SQL["last_company_in_file"] = """
WITH o AS (SELECT *, row_number() OVER () AS place FROM orders)
SELECT o_custkey, count(o_orderkey) AS order_count,
       arg_max(o_orderpriority, place) FILTER (WHERE o_orderpriority <> '4-NOT SPECIFIED') AS company
FROM o WHERE o_custkey IS NOT NULL GROUP BY o_custkey
"""

SQL["employee_first_last_line"] = """
WITH l AS (SELECT *, row_number() OVER () AS place FROM lineitem),
g AS (SELECT l_suppkey, min(place) AS low, max(place) AS high FROM l WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey)
SELECT s_suppkey, s_name, a.l_partkey AS first_part, a.l_orderkey AS first_order, b.l_partkey AS last_part, b.l_orderkey AS last_order
FROM supplier LEFT JOIN g ON g.l_suppkey = s_suppkey LEFT JOIN l a ON a.place = g.low LEFT JOIN l b ON b.place = g.high
"""

SQL["distinct_customers_rollup"] = """
WITH o AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, r_name AS region
           FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
                LEFT JOIN region ON r_regionkey = n_regionkey WHERE o_custkey IS NOT NULL)
SELECT 'month and region' AS level, month, region, count(DISTINCT o_custkey) AS n_customers FROM o
WHERE month IS NOT NULL AND region IS NOT NULL GROUP BY month, region
UNION ALL SELECT 'month', month, NULL, count(DISTINCT o_custkey) FROM o WHERE month IS NOT NULL GROUP BY month
UNION ALL SELECT 'region', NULL, region, count(DISTINCT o_custkey) FROM o WHERE region IS NOT NULL GROUP BY region
UNION ALL SELECT 'total', NULL, NULL, count(DISTINCT o_custkey) FROM o
"""
