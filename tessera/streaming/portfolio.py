"""The portfolio fold (STR-06) on Spark's state store.

``transformWithStateInPandas`` keeps, for each key, the holding folded so far
and the trades that wait for the watermark, in RocksDB state that Spark
checkpoints with the query: a query started again on the same checkpoint goes
on where the last committed batch ended, whatever process starts it.  An
event-time timer fires for the earliest waiting trade; all that the watermark
has passed are folded in order.  A trade older than what its key has folded is
emitted to the query's output, the side table of late rows, and not folded.

The holdings are read back from the checkpoint with the ``statestore`` source
(:func:`holdings`), the trades that still wait folded in by the batch
operator."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tessera.streaming.state import apply_trade, portfolio_fold

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Stands for a null time or tie-break; sorts first, so it is never waited for.
FIRST = -(1 << 63)
#: Spark hands rows over as named tuples, whose names cannot begin with "_".
_ROW = ["at", "seq", "d"]


class Holdings(StatefulProcessor):
    """State of one key: (owned, trades, last time, last tie-break) and the
    waiting trades."""

    def init(self, handle) -> None:
        self.handle = handle
        self.folded = handle.getValueState("folded", "owned double, trades long, at long, seq long")
        self.waiting = handle.getListState("waiting", "at long, seq long, d double")

    def _fold(self, rows: list[tuple], watermark_ms: int) -> None:
        """Fold what the watermark has passed; the rest waits for a timer."""
        limit = watermark_ms * 1000
        ready = sorted(r for r in rows if r[0] <= limit)
        rest = [r for r in rows if r[0] > limit]
        if ready:
            owned, trades, *_ = self.folded.get() if self.folded.exists() else (None, 0)
            for _, _, d in ready:
                owned = apply_trade(owned, d)
            self.folded.update((owned, trades + len(ready), ready[-1][0], ready[-1][1]))
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(min(r[0] for r in rest) // 1000 + 1)
        else:
            self.waiting.clear()

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []

    def handleInputRows(self, key, rows, timerValues):
        last = tuple(self.folded.get()[2:]) if self.folded.exists() else None
        fresh, late = [], []
        for pdf in rows:
            for r in zip(*(pdf[c].tolist() for c in _ROW)):
                (late if last is not None and r[:2] < last else fresh).append(r)
        if fresh:
            now = timerValues.getCurrentWatermarkInMs()
            if min(r[0] for r in fresh) <= now * 1000:
                self._fold(self._held() + fresh, now)
            else:
                self.waiting.appendList(fresh)
                self.handle.registerTimer(min(r[0] for r in fresh) // 1000 + 1)
        if late:
            yield pd.DataFrame([(key[0], *r) for r in late], columns=["k", *_ROW])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self._held()
        if held:
            self._fold(held, timerValues.getCurrentWatermarkInMs())
        return iter(())

    def close(self) -> None:
        pass


def _encoded(time: str, seq: str, delta: str) -> dict:
    first = F.lit(FIRST)
    return {"at": F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), first),
            "seq": F.coalesce(F.col(seq).cast("long"), first), "d": F.col(delta).cast("double")}


def start(trades: DataFrame, checkpoint: str, late: str, key: str, order: Sequence[str], delta: str, delay: str,
          **trigger):
    """Start the fold of the streaming frame ``trades``; ``order`` is the event
    time and a whole-number tie-break, late rows go to the folder ``late``."""
    spark = trades.sparkSession
    time, seq = order
    kind = trades.schema[key].dataType.simpleString()
    # Late rows must reach the operator, so the watermark stays on a column that it does not read.
    columns = [c.alias(n) for n, c in _encoded(time, seq, delta).items()]
    timed = trades.withColumn(time, F.col(time).cast("timestamp"))
    rows = timed.withWatermark(time, delay).select(F.col(key).alias("k"), *columns)
    out = rows.groupBy("k").transformWithStateInPandas(
        Holdings(), f"k {kind}, at long, seq long, d double", "Append", "EventTime")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # read when the query starts
    try:
        return (out.writeStream.format("parquet").option("path", late).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def late_rows(spark: SparkSession, late: str, key: str, order: Sequence[str], delta: str) -> DataFrame:
    """The side table: trades that came after later ones of their key were folded."""
    time, seq = order
    null = F.lit(FIRST)
    return spark.read.parquet(late).select(
        F.col("k").alias(key), F.timestamp_micros(F.nullif(F.col("at"), null)).alias(time), F.nullif(F.col("seq"), null).alias(seq),
        F.col("d").alias(delta))


def holdings(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """(key, owned, trades) from the state of the query with this checkpoint,
    the trades that still wait for the watermark folded in."""
    def state(name):
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    folded = state("folded").select(F.col("key.k").alias("_k"), "value.owned", "value.trades")
    waiting = state("waiting").select(F.col("key.k").alias("_k"), "list_element.at", "list_element.seq", "list_element.d")
    kind = folded.schema["_k"].dataType
    seed = folded.where("owned is not null").select(
        "_k", F.lit(0).alias("_rank"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("seq"),
        F.col("owned").alias("d"))
    rows = seed.unionByName(waiting.withColumn("_rank", F.lit(1)))
    owned = portfolio_fold(rows, "_k", ["_rank", "at", "seq"], "d", split=True).select("_k", "owned")
    count = folded.select("_k", "trades").unionByName(waiting.select("_k", F.lit(1).cast("long").alias("trades"))).groupBy(
        F.col("_k").alias("_n")).agg(F.sum("trades").alias("trades"))
    return owned.join(count, F.col("_k").eqNullSafe(F.col("_n"))).select(F.col("_k").cast(kind).alias(key), "owned", "trades")
