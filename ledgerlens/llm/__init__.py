"""Operators for large-scale training-data preparation.

Nothing outside this package imports it. Each operator module has a general
interface of its own; ``queries.py`` binds the operators to the driver tables.
Python code runs inside Spark tasks only (Arrow batches), so the package must be
importable on executors (``PYTHONPATH`` or ``--py-files``).
"""
