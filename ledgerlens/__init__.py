"""ledgerlens: customer, order and sales analytics written as Spark DataFrame plans.

Sub-packages:

* ``sources``   – table registry, typed CSV/Parquet readers, sinks.
* ``functions`` – column expressions (coercion, bins, rule tables, text).
* ``operators`` – reusable DataFrame operators (rollups, lookups, global ranks,
  crosstabs, profiles).
* ``plans``     – the analyses (RFM, cohorts, Pareto, features, rollups…),
  parameterised by column names so one plan serves any star schema.
* ``streaming`` – intentionally empty: every analysis is a bounded batch.
"""

__version__ = "0.1.0"
