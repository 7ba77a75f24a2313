"""Skew-proof per-key scans: position, running sum and previous value.

A window ``PARTITION BY key ORDER BY ...`` sends every row of a key to one
task; a key holding a third of the data would be sorted and scanned by a
single core.  Here the rows are sorted globally by ``(key, order)`` with a
range partitioning, which splits a hot key over as many partitions as its
size needs.  Windows over ``(partition, key)`` give *local* results that
restart at the partition edge, with Spark's own types (integers are summed as
decimals, so nothing is rounded).  A key continues across partition edges
only at the first key of a partition, so a carry table with one row per
partition - the count, sum and last value of the key that ends each earlier
partition - completes the results.  That table is bounded by the partition
count, so broadcasting it is safe; no step gathers a key's rows anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def segmented_scan(df: DataFrame, key: str | Column | Sequence, order: Sequence, sum_col: str | None = None,
                   prev_col: str | None = None, idx: str = "idx", running: str = "running",
                   prev: str = "prev") -> DataFrame:
    """Add ``idx`` (1-based position within the key), ``running`` (running
    sum of ``sum_col``; nulls skipped, null until the first value; bigint for
    integers, else double) and ``prev`` (``prev_col`` of the previous row of
    the key) in ``order``.  Null keys are one group."""
    from tessera.session import materialize

    keys = [key] if isinstance(key, (str, Column)) else list(key)
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    orders = [F.col(c) if isinstance(c, str) else c for c in order]
    whole = sum_col is not None and df.schema[sum_col].dataType.simpleString() in INTEGRAL
    # Sorted rows with partition id and in-partition sequence, checkpointed
    # once: rows and summaries must see the same partitions (separate range
    # exchanges would sample their own bounds).
    s = materialize(df.withColumn("_k", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))
                    .orderBy("_k", *orders)
                    .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    here = W.partitionBy("_pid", "_k").orderBy("_mid")
    upto = here.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = {"_lidx": F.row_number().over(here).cast("bigint")}
    if sum_col is not None:
        value = F.col(sum_col).cast("decimal(38,0)" if whole else "double")
        local["_lsum"] = F.sum(value).over(upto)
    if prev_col is not None:
        local["_lprev"] = F.lag(prev_col).over(here)
    loc = s.withColumns(local)

    # One row per (partition, key), then one per partition: its first key and
    # the count, sum and last value of the key that ends it.
    per_key = [F.count(F.lit(1)).alias("n"), F.max("_mid").alias("_mx"), F.min("_mid").alias("_mn")]
    if sum_col is not None:
        per_key.append(F.sum(value).alias("s"))
    if prev_col is not None:
        per_key.append(F.max_by(F.struct(F.col(prev_col).alias("v")), "_mid").alias("v"))
    groups = s.groupBy("_pid", "_k").agg(*per_key)
    last = F.struct(F.col("_k").alias("k"), "n", *["s"] * (sum_col is not None), *["v"] * (prev_col is not None))
    summ = groups.groupBy("_pid").agg(F.max_by(last, "_mx").alias("_last"), F.min_by("_k", "_mn").alias("_fk"))
    # Partitions whose last key is the same form one contiguous run (keys are
    # sorted); the running total within the run is the carry into the next.
    run_w = W.partitionBy("_last.k").orderBy("_pid").rowsBetween(W.unboundedPreceding, W.currentRow)
    summ = summ.withColumn("_cn", F.sum("_last.n").over(run_w))
    if sum_col is not None:
        summ = summ.withColumn("_cs", F.sum("_last.s").over(run_w))
    by_pid = W.orderBy("_pid")  # over one row per partition
    same = F.lag("_pid").over(by_pid).isNotNull() & F.lag("_last.k").over(by_pid).eqNullSafe(F.col("_fk"))
    carry = [F.col("_pid"), F.col("_fk"), F.when(same, F.lag("_cn").over(by_pid)).otherwise(F.lit(0)).alias("_ccnt")]
    if sum_col is not None:
        carry.append(F.when(same, F.lag("_cs").over(by_pid)).alias("_csum"))
    if prev_col is not None:
        carry.append(F.when(same, F.lag("_last.v").over(by_pid)).alias("_cprev"))
    j = loc.join(F.broadcast(summ.select(*carry)), "_pid")
    cont = F.col("_k").eqNullSafe(F.col("_fk"))
    out = j.withColumn(idx, (F.col("_lidx") + F.when(cont, F.col("_ccnt")).otherwise(F.lit(0))).cast("bigint"))
    if sum_col is not None:
        carried = F.when(cont, F.col("_csum"))
        total = F.when(F.col("_lsum").isNull(), carried).when(carried.isNull(), F.col("_lsum")).otherwise(
            F.col("_lsum") + carried)
        out = out.withColumn(running, total.cast("bigint" if whole else "double"))
    if prev_col is not None:
        out = out.withColumn(prev, F.when(F.col("_lidx") == 1, F.when(cont, F.col("_cprev.v")))
                             .otherwise(F.col("_lprev")))
    return out.drop("_k", "_pid", "_mid", "_lidx", "_lsum", "_lprev", "_fk", "_ccnt", "_csum", "_cprev")


def _sorted(df: DataFrame, keys: Sequence[Column], orders: Sequence[Column]) -> DataFrame:
    """Rows sorted by (_k, order) with partition and place, checkpointed once."""
    from tessera.session import materialize

    k = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(keys)]) if keys else F.lit(0)
    return materialize(df.withColumn("_k", k).orderBy("_k", *orders)
                       .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))


def run_scan(df: DataFrame, key: str | Column | Sequence, order: Sequence, value: str, run: str = "run_no",
             starts: str = "_new_run") -> DataFrame:
    """Add ``run`` (the number, from 1, of the run of equal ``value`` within
    the key) and ``starts`` (whether the row begins it), in one sort: a run
    count within each partition, completed by one carry a partition holding
    the count and the last value of the key that ends the one before."""
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    s = _sorted(df, keys, [F.col(c) if isinstance(c, str) else c for c in order])
    here = W.partitionBy("_pid", "_k").orderBy("_mid")
    first = F.row_number().over(here) == 1
    new = first | ~F.lag(value).over(here).eqNullSafe(F.col(value))
    loc = s.withColumns({"_first": first, "_new": new}).withColumn("_runs", F.sum(F.col("_new").cast("bigint")).over(
        here.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # One row per (partition, key), then one per partition: its first and last key.
    v = F.struct(F.col(value).alias("v"))
    groups = loc.groupBy("_pid", "_k").agg(F.max("_runs").alias("n"), F.min("_mid").alias("_mn"), F.max("_mid").alias("_mx"),
                                           F.min_by(v, "_mid").alias("fv"), F.max_by(v, "_mid").alias("lv"))
    summ = groups.groupBy("_pid").agg(
        F.min_by(F.struct(F.col("_k").alias("k"), "fv"), "_mn").alias("_fk"),
        F.max_by(F.struct(F.col("_k").alias("k"), "n", "lv"), "_mx").alias("_last"))
    by_pid = W.orderBy("_pid")  # over one row per partition
    before = F.lag("_last").over(by_pid)
    summ = summ.withColumn("_cont", before.isNotNull() & before["k"].eqNullSafe(F.col("_fk.k")))
    # A run that goes on from the partition before is not counted again.
    summ = summ.withColumn("_joined", F.col("_cont") & F.lag("_last.lv").over(by_pid).eqNullSafe(F.col("_fk.fv")))
    whole = F.col("_fk.k").eqNullSafe(F.col("_last.k"))
    run_w = W.partitionBy("_last.k").orderBy("_pid").rowsBetween(W.unboundedPreceding, W.currentRow)
    summ = summ.withColumn("_upto", F.sum(F.col("_last.n") - F.when(whole & F.col("_joined"), 1).otherwise(0)).over(run_w))
    carry = summ.select("_pid", F.col("_fk.k").alias("_ck"), "_joined", F.when(
        F.col("_cont"), F.lag("_upto").over(by_pid) - F.col("_joined").cast("bigint")).otherwise(F.lit(0)).alias("_carry"))
    j = loc.join(F.broadcast(carry), "_pid")
    cont = F.col("_k").eqNullSafe(F.col("_ck"))
    return j.withColumns({
        run: (F.col("_runs") + F.when(cont, F.col("_carry")).otherwise(F.lit(0))).cast("bigint"),
        starts: F.col("_new") & ~(F.col("_first") & cont & F.col("_joined"))}).drop(
        "_k", "_pid", "_mid", "_first", "_new", "_runs", "_ck", "_joined", "_carry")


def last_seen(df: DataFrame, order: Sequence, value: str, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` at or before each row of the
    whole frame in ``order``.  No key, so no skew: a row's place is all that
    counts, and one carry a partition crosses the edges."""
    s = _sorted(df, [], [F.col(c) if isinstance(c, str) else c for c in order])
    here = W.partitionBy("_pid").orderBy("_mid").rowsBetween(W.unboundedPreceding, W.currentRow)
    loc = s.withColumn("_seen", F.last(value, ignorenulls=True).over(here))
    ends = s.where(F.col(value).isNotNull()).groupBy("_pid").agg(F.max_by(value, "_mid").alias("_end"))
    parts = s.select("_pid").distinct().join(ends, "_pid", "left")
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)  # over one row per partition
    carry = parts.select("_pid", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    return loc.join(F.broadcast(carry), "_pid").withColumn(name, F.coalesce("_seen", "_carry")).drop(
        "_k", "_pid", "_mid", "_seen", "_carry")


def fold_fragments(df: DataFrame, key: str | Sequence[str], order: Sequence, value: Column, zero: Column, merge) -> DataFrame:
    """(keys, part, fragment): the ordered fold of each key's values, in parts.

    ``merge`` (two columns to one) is associative with identity ``zero`` but
    need not commute.  The range sort by (key, order) cuts a hot key into
    partitions; the stretch of a key in one of them is folded there, so no
    task holds more of a key than a partition does.  Folding the fragments by
    ``part`` gives the whole fold."""
    names = [key] if isinstance(key, str) else list(key)
    s = _sorted(df.withColumn("_v", value), [F.col(k) for k in names], [F.col(c) if isinstance(c, str) else c for c in order])
    stretch = s.groupBy("_pid", "_k").agg(F.array_sort(F.collect_list(F.struct("_mid", "_v"))).alias("_vs"))
    folded = F.aggregate("_vs", zero, lambda acc, x: merge(acc, x["_v"]))
    return stretch.select(*[F.col(f"_k.k{i}").alias(k) for i, k in enumerate(names)], F.col("_pid").alias("part"),
                          folded.alias("fragment"))


def ordered_fold(df: DataFrame, key: str | Sequence[str], order: Sequence, value: Column, zero: Column, merge,
                 name: str = "folded") -> DataFrame:
    """One row a key: the ordered fold of its values by any monoid (AGG-33),
    its fragments (at most one a partition) folded in turn.  Where the result
    itself grows with the group, as concatenation does, use
    :func:`fold_fragments` and never build it."""
    names = [key] if isinstance(key, str) else list(key)
    parts = fold_fragments(df, key, order, value, zero, merge).groupBy(*names).agg(
        F.array_sort(F.collect_list(F.struct("part", "fragment"))).alias("_ps"))
    return parts.select(*names, F.aggregate("_ps", zero, lambda acc, x: merge(acc, x["fragment"])).alias(name))
