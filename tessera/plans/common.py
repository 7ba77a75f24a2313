"""Helpers shared by the plan modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.tables import table


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give CPU-heavy per-row work (tokenising, regex parsing) the whole
    cluster when the scan yields fewer partitions than there are cores — a
    small file or a file written as one row group is read by one task.

    With ``keys`` the rows are hash-partitioned on them, which later
    windows/aggregates clustered on a superset of the keys reuse without
    another exchange.  Without keys, a round-robin repartition is added only
    when the input is under-partitioned, so on a large input (thousands of
    splits) this is a no-op and adds no shuffle."""
    if keys:
        return df.repartition(*keys)
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()  # split planning only, no job
    except Exception:  # e.g. Spark Connect: no RDD view; keep the scan as is
        return df
    return df.repartition(cores) if parts < cores else df
