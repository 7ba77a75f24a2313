"""Read-through lookup cache with per-key expiry (STR-08).

Batch form: keys are joined to the cache table; entries older than the
time-to-live count as missing; misses are "fulfilled" by a DataFrame-level
function (the slow source) and reported with where the value came from.
Streaming form: the same function inside ``foreachBatch`` against a cache
table that is re-read every micro-batch (a stream-static join), so updates
to the cache become visible without restarting the query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.streaming.state import complete_batches


def read_through(keys: DataFrame, key: str, cache: DataFrame, value: str,
                 fulfill: Callable[[DataFrame], DataFrame], now=None, ttl_seconds: int | None = None,
                 stamp: str = "cached_at") -> DataFrame:
    """(key, value, source) with source 'cache' or 'fulfilled'; keys neither
    cached nor fulfillable keep a null value and source 'missing'."""
    c = cache
    if ttl_seconds is not None:
        now = now if now is not None else F.current_timestamp()
        c = c.where(F.col(stamp) >= now - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    k = keys.select(key).distinct()
    hit = k.join(c.select(key, value), key, "left")
    missing = hit.where(F.col(value).isNull()).select(key)
    got = fulfill(missing).select(key, F.col(value).alias("_f"))
    j = hit.join(got, key, "left")
    source = (F.when(F.col(value).isNotNull(), "cache").when(F.col("_f").isNotNull(), "fulfilled")
              .otherwise("missing"))
    return j.select(key, F.coalesce(F.col(value), F.col("_f")).alias(value), source.alias("source"))


def read_through_stream(keys_stream: DataFrame, key: str, load_cache: Callable[[], DataFrame], value: str,
                        fulfill: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None],
                        checkpoint: str, ttl_seconds: int | None = None):
    """Streaming read-through lookup (STR-08): every micro-batch of keys is
    resolved against the cache table *as it is at that batch* (``load_cache``
    re-reads it), misses are fulfilled, and the resolved batch goes to
    ``sink(df, batch_id)``.  Returns the started query."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sink(read_through(batch, key, load_cache(), value, fulfill, ttl_seconds=ttl_seconds), batch_id)

    return (keys_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


class ExpiringCache:
    """Read-through cache inside a stream, for ``foreachBatch`` (STR-08).

    The cache is a table (key, value, cached_at) in a shared folder with a
    version for each batch.  A batch's clock is the newest event time seen so
    far; entries older than ``ttl_seconds`` by it count as missing, misses are
    fulfilled, and the next version holds the entries still alive and the new
    ones, so it never grows beyond the keys of one time to live.  Versions are
    found in the folder, so a batch that is run again, or a new process,
    starts from the version before."""

    def __init__(self, spark, folder: str, key: str, value: str, time: str, ttl_seconds: int,
                 fulfill: Callable[[DataFrame], DataFrame]):
        self.spark, self.folder, self.key, self.value, self.time = spark, folder, key, value, time
        self.ttl_seconds, self.fulfill = ttl_seconds, fulfill

    def step(self, batch: DataFrame, batch_id: int) -> None:
        prior = max((b for b in complete_batches(self.spark, f"{self.folder}/cache") if b < batch_id), default=None)
        now = batch.agg(F.max(self.time)).first()[0]
        if prior is None:
            values = self.fulfill(batch.select(self.key).limit(0)).select(self.key, self.value)
            cache = values.withColumn("cached_at", F.lit(now))
        else:
            cache = self.spark.read.parquet(f"{self.folder}/cache/{prior}")
            last = cache.agg(F.max("cached_at")).first()[0]
            now = max((x for x in (now, last) if x is not None), default=None)
        at = F.lit(now)
        found = read_through(batch, self.key, cache, self.value, self.fulfill, now=at, ttl_seconds=self.ttl_seconds)
        found = found.withColumn("looked_up_at", at)
        found.write.mode("overwrite").parquet(f"{self.folder}/lookups/{batch_id}")
        found = self.spark.read.parquet(f"{self.folder}/lookups/{batch_id}")
        alive = cache.where(F.col("cached_at") >= at - F.make_dt_interval(secs=F.lit(self.ttl_seconds)))
        new = found.where("source = 'fulfilled'").select(self.key, self.value, F.col("looked_up_at").alias("cached_at"))
        alive.unionByName(new).write.mode("overwrite").parquet(f"{self.folder}/cache/{batch_id}")

    def lookups(self) -> DataFrame:
        """(key, value, source, looked_up_at) of every key of every batch."""
        return self.spark.read.parquet(f"{self.folder}/lookups/*")
