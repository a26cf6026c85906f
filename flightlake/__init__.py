"""flightlake: air-traffic analytics expressed as Spark DataFrame plans.

Functions take DataFrames and return DataFrames; no module-level session.
Every hot-path expression is a built-in Spark SQL function (no Python UDFs).
"""

__all__ = ["session", "schemas", "sources", "functions", "operators", "plans", "streaming"]
