"""lakelens: analytics operators written as plain Spark DataFrame functions.

Every operator takes a DataFrame (plus parameters) and returns a DataFrame, so
they chain with ``df.transform(...)``.  Work stays in Catalyst expressions,
Spark ML and, where nothing built-in fits, a few Arrow-batched pandas UDFs.
"""

__all__ = ["session"]
