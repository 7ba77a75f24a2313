"""Several streams merged into one (SET-02, STR-02): first come, first served.

All sources are read by one query, so Spark takes what each has new into one
micro-batch and commits their offsets together; rows keep the name of their
source and the number of the batch in which they came."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def start_merge(streams: dict[str, DataFrame], folder: str, checkpoint: str, **trigger):
    """Start one query over the streaming frames (of one schema); each batch
    is a table in ``folder``, written over if it is run again."""
    named = [df.withColumn("source", F.lit(name)) for name, df in streams.items()]
    both = reduce(DataFrame.unionByName, named)

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("arrival", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{folder}/{batch_id}")

    return (both.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """All rows that have come, with ``source`` and ``arrival``."""
    return spark.read.parquet(f"{folder}/*")


def first_come(rows: DataFrame, key: str, tie: str) -> DataFrame:
    """The first row of each key: the earliest arrival, then ``tie``."""
    others = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct("arrival", tie)).alias("_f")
    return rows.groupBy(key).agg(first).select(key, *[F.col(f"_f.{c}").alias(c) for c in others])
