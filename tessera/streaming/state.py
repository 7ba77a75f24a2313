"""Keyed, order-dependent state (STR-06, STR-07) in batch and streaming form.

The portfolio rule — a buy adds; a sell subtracts only when the quantity is
at most what is owned, otherwise it is ignored; a sell of a stock never
bought is ignored — is a left fold that depends on order, so a plain ``sum``
is wrong and it is not associative.

* Batch: rows are hash-partitioned by key and sorted by (key, order) inside
  each partition, then one ``mapInPandas`` pass streams through them
  keeping only the current key's state.  No key's rows are ever collected
  into one list, so memory per task is bounded by the Arrow batch size even
  for a hot key (which still runs in one task: the fold is sequential).
* Streaming: every micro-batch is folded by the batch operator, seeded from
  a state table.  Rows newer than the watermark (the newest time seen less a
  declared delay) are held back and folded, in order, with later batches;
  rows older than what their key has already folded go to a quarantine table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_trade(owned: float | None, delta: float) -> float | None:
    """One step of the portfolio fold; ``None`` = stock never bought."""
    if delta >= 0:
        return (owned or 0) + delta
    if owned is None:
        return None
    return owned + delta if -delta <= owned else owned


def _fold_partition(delta: str):
    """Rows sorted by (_k, order) -> one row a key.  ``_k`` is the key as
    text, null for null keys (one group)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        started, cur_key, owned, n = False, None, None, 0
        out: list[tuple] = []

        def frame():
            pdf = pd.DataFrame(out, columns=["_k", "owned", "trades"])
            out.clear()
            return pdf

        for pdf in batches:
            for k, d in zip(pdf["_k"].tolist(), pdf[delta].tolist()):
                if not started or k != cur_key:
                    if started:
                        out.append((cur_key, owned, n))
                        if len(out) >= 10_000:
                            yield frame()
                    started, cur_key, owned, n = True, k, None, 0
                owned = apply_trade(owned, d)
                n += 1
        if started:
            out.append((cur_key, owned, n))
        if out:
            yield frame()
    return run


def _keyed(df: DataFrame, key: str, order: Sequence[str], delta: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("_k"), *order, F.col(delta).cast("double").alias(delta))


_FOLDED = "_k string, owned double, trades long"


def portfolio_fold(df: DataFrame, key: str, order: Sequence[str], delta: str,
                   num_partitions: int | None = None, split: bool = False, keep_unknown: bool = False) -> DataFrame:
    """Final owned quantity per key after folding signed trades in order.
    Keys whose trades never included a buy have no holding and no row, unless
    ``keep_unknown``.  Null keys are one group.

    ``split`` cuts hot keys across partitions (:func:`portfolio_fold_split`)."""
    if split:
        return portfolio_fold_split(df, key, order, delta, keep_unknown)
    parts = _keyed(df, key, order, delta)
    # Partition on a hash *expression* of the key, not on the key column: an
    # upstream join on the key already hash-partitions by it, and Catalyst
    # would then drop a plain repartition(key) while AQE may split a skewed
    # join partition, leaving one key's rows in several tasks.  A partitioning
    # nothing upstream provides always gets its own exchange, which AQE never
    # splits.
    part_key = F.xxhash64(F.col("_k"))
    parts = parts.repartition(num_partitions, part_key) if num_partitions else parts.repartition(part_key)
    ordered = parts.sortWithinPartitions("_k", *order).select("_k", delta)
    out = ordered.mapInPandas(_fold_partition(delta), _FOLDED)
    out = out if keep_unknown else out.where("owned is not null")
    return out.select(F.col("_k").cast(df.schema[key].dataType).alias(key), "owned", "trades")


def complete_batches(spark, folder: str) -> list[int]:
    """Batch ids of the tables under ``folder`` that were written to the end."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or ()
    return sorted(int(f.getPath().getParent().getName()) for f in found)


class PortfolioStream:
    """Streaming form of the portfolio fold, for ``foreachBatch``.

    State, held rows and quarantine are Parquet tables in ``folder`` (a shared
    folder), written once for each batch id, so a batch that is run again
    after a failure starts from the same state.  ``order[0]`` is the event
    time; rows up to ``delay`` late are folded in order."""

    def __init__(self, spark, folder: str, key: str, order: Sequence[str], delta: str, delay: str):
        self.spark, self.folder, self.key, self.order, self.delta, self.delay = spark, folder, key, list(order), delta, delay

    def _steps(self) -> list[int]:
        """Batches folded so far, by this or an earlier process."""
        return complete_batches(self.spark, f"{self.folder}/state")

    def _read(self, name: str, batch: int | None, schema) -> DataFrame:
        if batch is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/{batch}")

    def step(self, batch: DataFrame, batch_id: int, flush: bool = False) -> None:
        rows = batch.select(self.key, *self.order, F.col(self.delta).cast("double").alias(self.delta))
        fields = {f.name: f.dataType for f in rows.schema.fields}
        state_schema = T.StructType([T.StructField(self.key, fields[self.key]), T.StructField("owned", T.DoubleType()),
                                     T.StructField("trades", T.LongType())]
                                    + [T.StructField(f"_last_{c}", fields[c]) for c in self.order])
        prior = max((b for b in self._steps() if b < batch_id), default=None)
        state = self._read("state", prior, state_schema)
        held = self._read("held", prior, T.StructType([T.StructField(n, d) for n, d in fields.items()]))
        known = state.select(F.col(self.key).alias("_sk"), F.struct(*[F.col(f"_last_{c}").alias(c) for c in self.order]).alias("_lo"),
                             F.lit(True).alias("_seen"))
        todo = held.unionByName(rows)
        newest = todo.agg(F.max(self.order[0]).alias("m")).first()["m"]
        old = todo.join(known, F.col(self.key).eqNullSafe(F.col("_sk")), "left")
        at = F.struct(*[F.col(c) for c in self.order])
        late = F.coalesce(F.col("_seen"), F.lit(False)) & (at < F.col("_lo"))
        old.where(late).select(*rows.columns).write.mode("overwrite").parquet(f"{self.folder}/quarantine/{batch_id}")
        fresh = old.where(~late).select(*rows.columns)
        # Null times sort first, so they are never waited for.
        wait = F.lit(False) if flush or newest is None else F.coalesce(
            F.col(self.order[0]) > F.lit(newest) - F.expr(f"interval {self.delay}"), F.lit(False))
        fresh.where(wait).write.mode("overwrite").parquet(f"{self.folder}/held/{batch_id}")
        ready = fresh.where(~wait)
        # What a key owns goes first, as one buy; it is not counted as a trade.
        seed = state.where("owned is not null").select(
            self.key, *[F.lit(None).cast(fields[c]).alias(c) for c in self.order], F.col("owned").alias(self.delta),
            F.lit(0).alias("_rank"))
        both = seed.unionByName(ready.withColumn("_rank", F.lit(1)))
        now = portfolio_fold(both, self.key, ["_rank", *self.order], self.delta, keep_unknown=True).select(
            F.col(self.key).alias("_k1"), "owned")
        count = (state.select(self.key, "trades", F.struct(*[F.col(f"_last_{c}").alias(c) for c in self.order]).alias("o"))
                 .unionByName(ready.select(self.key, F.lit(1).cast("long").alias("trades"), at.alias("o")))
                 .groupBy(F.col(self.key).alias("_k2")).agg(F.sum("trades").alias("trades"), F.max("o").alias("o")))
        new = count.join(now, F.col("_k1").eqNullSafe(F.col("_k2")), "left").select(
            F.col("_k2").alias(self.key), "owned", "trades", *[F.col(f"o.{c}").alias(f"_last_{c}") for c in self.order])
        new.write.mode("overwrite").parquet(f"{self.folder}/state/{batch_id}")

    def result(self) -> DataFrame:
        """(key, owned, trades) after the held rows are folded too."""
        steps = self._steps()
        if not steps:
            raise ValueError("no batch has been folded")
        rows = self.spark.read.parquet(f"{self.folder}/held/{max(steps)}").schema
        self.step(self.spark.createDataFrame([], rows), max(steps) + 1, flush=True)
        end = self.spark.read.parquet(f"{self.folder}/state/{max(steps) + 1}")
        return end.where("owned is not null").select(self.key, "owned", "trades")

    def quarantine(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/quarantine/*")


def earliest_claims(requests: DataFrame, item: str, order: Sequence[str], claimant: str) -> DataFrame:
    """Ticket holds (STR-07): for each item the earliest request wins; later
    requests for a held item are refused.  ``min_by`` keeps it one aggregate."""
    o = F.struct(*[F.col(c) for c in order])
    return requests.groupBy(item).agg(F.min_by(F.col(claimant), o).alias(claimant))


def remaining_pool(pool: DataFrame, holds: DataFrame, item: str) -> DataFrame:
    """Items still available after the holds (bag difference, STR-07/SET-03)."""
    return pool.select(item).exceptAll(holds.select(item))


# ----------------------------------------------------------- hot keys ----
#
# A stretch of one key's trades is a function of the holding it is entered
# with.  Entered unknown it gives its ``fresh`` result; entered with ``x >= T``
# (T is the least holding at which no sell is skipped) it gives ``x + D``, D
# the sum of its deltas; below T it is piecewise ``x + add``, a new piece
# wherever another set of sells is skipped.  So a hot key is cut into
# partition-sized stretches, summarised in parallel and chained over one row a
# stretch.  There can be more pieces than ``MAX_PIECES``; then the summary stops
# at T, and a stretch that is entered below it is replayed from the holding it
# is entered with, that stretch alone, and the chain goes on from its result.

MAX_PIECES = 512


def _step_pieces(start, add, d):
    """(start, add) after one more trade: entered with x in [start[i],
    start[i+1]) the trades give x + add[i]; None beyond ``MAX_PIECES``."""
    import numpy as np

    if d >= 0:
        return start, add + d
    cut = -d - add  # entered with less, a piece skips this sell
    split = (cut > start) & (cut < np.append(start[1:], np.inf))
    if split.any():
        start, add = np.concatenate([start, cut[split]]), np.concatenate([add, add[split]])
        order = np.argsort(start, kind="stable")
        start, add = start[order], add[order]
    add = np.where(start + add >= -d, add + d, add)
    same = np.concatenate(([False], add[1:] == add[:-1]))
    if same.any():
        start, add = start[~same], add[~same]
    return None if len(start) > MAX_PIECES else (start, add)


def _segments(delta: str):
    """Sorted rows -> a summary of each (partition, key) stretch.  Only the
    first key of a partition can have been entered with a holding, so only it
    gets pieces."""
    cols = ["_pid", "_k", "fresh", "trades", "D", "T", "start", "add"]

    def run(batches):
        import numpy as np

        cur, fresh, n, total, low, first = None, None, 0, 0.0, 0.0, True
        known = (np.zeros(1), np.zeros(1))
        rows: list[tuple] = []

        def frame():
            pdf = pd.DataFrame(rows, columns=cols)
            rows.clear()
            return pdf

        def done():
            pieces = (None, None) if known is None or not first else tuple(x.tolist() for x in known)
            rows.append((*cur, fresh, n, total, max(0.0, -low), *pieces))

        for pdf in batches:
            for pid, k, d in zip(pdf["_pid"].tolist(), pdf["_k"].tolist(), pdf[delta].tolist()):
                if cur is None or k != cur[1]:
                    if cur is not None:
                        done()
                        first = False
                        if len(rows) >= 10_000:
                            yield frame()
                    cur, fresh, n, total, low = (pid, k), None, 0, 0.0, 0.0
                fresh = apply_trade(fresh, d)
                n += 1
                total += d
                low = min(low, total)
                if first and known is not None:
                    known = _step_pieces(*known, d)
        if cur is not None:
            done()
        if rows:
            yield frame()
    return run


def _chain(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The stretches of one key from the last known holding on: the final
    holding, or the stretch to replay and the holding it is entered with."""
    from bisect import bisect_right

    pdf = pdf.sort_values("_pid")
    state, wait = None, None
    for r in pdf.itertuples(index=False):
        if not pd.isna(r.replayed):
            state = float(r.replayed)
        elif state is None:
            state = None if pd.isna(r.fresh) else float(r.fresh)
        elif state >= r.T:
            state = state + r.D
        elif r.start is not None:
            state = state + r.add[bisect_right(r.start, state) - 1]
        else:
            wait = r[0]  # its partition
            break
    return pd.DataFrame({"_k": [key[0]], "owned": [state], "trades": [int(pdf["trades"].sum())], "wait": [wait]})


def portfolio_fold_split(df: DataFrame, key: str, order: Sequence[str], delta: str,
                         keep_unknown: bool = False) -> DataFrame:
    """The portfolio fold with hot keys cut across partitions (see above).
    Same output as :func:`portfolio_fold`; no task reads more of a key than
    one partition holds."""
    from tessera.session import materialize

    s = materialize(_keyed(df, key, order, delta).orderBy("_k", *order).withColumn("_pid", F.spark_partition_id()))
    seg = s.select("_pid", "_k", delta).mapInPandas(
        _segments(delta), "_pid int, _k string, fresh double, trades long, D double, T double, "
                          "start array<double>, add array<double>")
    seg = materialize(seg)  # one row per (partition, key) stretch; read below by several branches
    spans = seg.groupBy(F.col("_k").alias("_g")).agg(F.count(F.lit(1)).alias("_parts"))
    of = seg.join(spans, F.col("_k").eqNullSafe(F.col("_g")))
    out = of.where("_parts = 1").select("_k", F.col("fresh").alias("owned"), "trades")
    # Keys spanning partitions: at most one stretch per partition each.
    multi = of.where("_parts > 1").select(*seg.columns, F.lit(None).cast("double").alias("replayed"))
    while True:
        chained = materialize(multi.groupBy("_k").applyInPandas(_chain, _FOLDED + ", wait int"))
        out = out.unionByName(chained.where("wait is null").select("_k", "owned", "trades"))
        # At most one stretch a key waits, and fewer keys than partitions span several.
        waiting = chained.where("wait is not null").select(F.col("_k").alias("_g"), F.col("wait").alias("_p"), "owned")
        if waiting.isEmpty():
            break
        here = F.col("_k").eqNullSafe(F.col("_g")) & (F.col("_pid") == F.col("_p"))
        again = s.join(F.broadcast(waiting.select("_g", "_p")), here, "left_semi").select("_k", *order, delta)
        entered = waiting.select(F.col("_g").alias("_k"), *[F.lit(None).cast(s.schema[c].dataType).alias(c) for c in order],
                                 F.col("owned").alias(delta), F.lit(0).alias("_rank"))
        folded = portfolio_fold(entered.unionByName(again.withColumn("_rank", F.lit(1))), "_k", ["_rank", *order], delta)
        known = folded.select(F.col("_k").alias("_g"), F.col("owned").alias("_now")).join(
            waiting.select(F.col("_g").alias("_h"), "_p"), F.col("_g").eqNullSafe(F.col("_h")))
        multi = materialize(
            multi.join(F.broadcast(waiting.select("_g")), F.col("_k").eqNullSafe(F.col("_g")), "left_semi")
            .join(F.broadcast(known.select("_g", "_p", "_now")), here, "left")
            .select(*seg.columns, F.coalesce("_now", "replayed").alias("replayed")))
    out = out.select(F.col("_k").cast(df.schema[key].dataType).alias(key), "owned", "trades")
    return out if keep_unknown else out.where("owned is not null")
