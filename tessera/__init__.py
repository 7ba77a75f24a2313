"""tessera — composable DataFrame -> DataFrame analytics operators on Spark.

Every operator is a plain function over ``pyspark.sql.DataFrame`` built from
Catalyst-visible expressions, so predicate pushdown, column pruning, partial
aggregation and adaptive re-planning apply without any engine of our own.
"""

__version__ = "0.1.0"
