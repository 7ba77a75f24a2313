"""Order-dependent operators and positional joins (JN-06..10).

A DataFrame has no row order, so every operator here takes explicit order
columns that must form a total order (add a unique tie-break).  Two shapes:

* per-group sequences (``partition`` given) use the segmented scan of
  :mod:`tessera.operators.scan` at every size: a global range sort splits a
  hot key over many partitions and a carry table (one row per partition)
  stitches them together;
* whole-table positions use :func:`global_row_number`, which never funnels
  rows through a single task: a range-partitioned sort, one small aggregate
  of per-partition counts, and a broadcast of those counts (one row per
  partition, bounded by the partition count) to turn local indexes into
  global ones.  The sorted, numbered rows are checkpointed once so both
  reads see the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.numeric import fround


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def global_row_number(df: DataFrame, order: Sequence, name: str = "pos", start: int = 1) -> DataFrame:
    """Consecutive positions ``start, start+1, ...`` in ``order`` over the
    whole frame, computed without a single-partition window: a range sort,
    per-partition counts, and a broadcast of their prefix offsets."""
    from tessera.session import materialize

    # The numbered rows are read by two branches (counts and the final
    # join); materialising them makes both see the same partitions.
    s = materialize(df.orderBy(*_cols(order))
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    per_part = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # One row per partition: the prefix over it is tiny and the result is
    # safe to broadcast (bounded by spark.sql.shuffle.partitions).
    offs = per_part.select(
        "_pid", "_first",
        F.coalesce(F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offs), "_pid")
    pos = F.col("_off") + (F.col("_mid") - F.col("_first")) + F.lit(start)
    return out.withColumn(name, pos.cast("bigint")).drop("_pid", "_mid", "_first", "_off")


def _names(x):
    return [x] if isinstance(x, str) else list(x)


def key_scan(df: DataFrame, partition, order, sum_col: str | None = None, prev_col: str | None = None,
             idx: str = "idx", running: str = "running", prev: str = "prev", keep: Sequence[str] | None = None) -> DataFrame:
    """Position within the group, running sum (bigint for integers, else
    double) and previous value, by the segmented scan.  ``keep`` names the
    columns the result needs besides; others are not carried along."""
    from tessera.operators.scan import segmented_scan

    names = [partition] if isinstance(partition, (str, Column)) else list(partition)
    orders = [order] if isinstance(order, (str, Column)) else list(order)
    if keep is not None and all(isinstance(x, str) for x in names + orders):
        wanted = dict.fromkeys([*names, *orders, *(x for x in (sum_col, prev_col) if x), *keep])
        df = df.select(*wanted)
    return segmented_scan(df, names, orders, sum_col, prev_col, idx, running, prev)


def with_position(df: DataFrame, partition, order, name: str = "pos", start: int = 1,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """Position within each partition group (1-based by default)."""
    out = key_scan(df, partition, order, idx="_idx", keep=keep)
    return out.withColumn(name, (F.col("_idx") - 1 + start).cast("bigint")).drop("_idx")


def running_sum(df: DataFrame, partition, order, value: str, name: str = "running") -> DataFrame:
    """Prefix sum within each group (WIN-03): exact for integers."""
    return key_scan(df, partition, order, sum_col=value, idx="_idx", running=name).drop("_idx")


def interval_deltas(df: DataFrame, keys, start: str, stop: str) -> DataFrame:
    """Explode intervals into +1 (start) / -1 (stop) events.  ``kind`` sorts a
    stop (0) before a start (1) at equal times, as the reference orders them."""
    ev = F.explode(F.array(
        F.struct(F.col(start).alias("t"), F.lit(1).alias("kind"), F.lit(1).alias("delta")),
        F.struct(F.col(stop).alias("t"), F.lit(0).alias("kind"), F.lit(-1).alias("delta"))))
    return df.select(*_cols(keys), ev.alias("_e")).select(*_cols(keys), "_e.t", "_e.kind", "_e.delta")


def max_concurrency(df: DataFrame, keys, start: str, stop: str, name: str = "rooms") -> DataFrame:
    """Maximum number of simultaneously open intervals per key (WIN-01).

    Deltas are first summed per (key, time): with stops ordered before starts
    the peak at a time is the prefix *including* every event at that time, so
    the scan only sees one row per distinct time per key.  The prefix sum is
    the measured key scan, so a key with very many distinct times is split
    across tasks as well."""
    d = interval_deltas(df, keys, start, stop).groupBy(*_cols(keys), "t").agg(F.sum("delta").alias("delta"))
    occ = key_scan(d, keys, ["t"], sum_col="delta", idx="_i", running="_occ")
    return occ.groupBy(*_cols(keys)).agg(F.greatest(F.max("_occ"), F.lit(0)).cast("bigint").alias(name))


def occupancy_series(df: DataFrame, keys, start: str, stop: str, tie: Sequence[str] = ()) -> DataFrame:
    """The occupancy after each start/stop event, per key (WIN-02); the
    series starts from 0 before the first event.  ``tie`` columns make the
    order total when several events share a time and kind."""
    ev = F.explode(F.array(
        F.struct(F.col(start).alias("t"), F.lit(1).alias("kind"), F.lit(1).alias("delta")),
        F.struct(F.col(stop).alias("t"), F.lit(0).alias("kind"), F.lit(-1).alias("delta"))))
    d = df.select(*_cols(keys), *tie, ev.alias("_e")).select(*_cols(keys), *tie, "_e.t", "_e.kind", "_e.delta")
    out = key_scan(d, keys, ["t", "kind", *tie], sum_col="delta", idx="step", running="occupancy")
    return out.withColumn("occupancy", F.col("occupancy").cast("bigint"))


def _runs(df: DataFrame, partition, order, value: str) -> DataFrame:
    from tessera.operators.scan import run_scan

    return run_scan(df, partition, [order] if isinstance(order, (str, Column)) else list(order), value)


def change_flags(df: DataFrame, partition, order, value: str) -> DataFrame:
    """``_new_run`` is 1 where ``value`` differs from the previous row in the group."""
    return _runs(df, partition, order, value).withColumn("_new_run", F.col("_new_run").cast("int")).drop("run_no")


def compress(df: DataFrame, partition, order, value: str) -> DataFrame:
    """Drop consecutive duplicates (WIN-04)."""
    return change_flags(df, partition, order, value).where("_new_run = 1").drop("_new_run")


def runs(df: DataFrame, partition, order, value: str) -> DataFrame:
    """Island id per row: running count of value changes (gaps and islands)."""
    return _runs(df, partition, order, value).drop("_new_run")


def run_length_encode(df: DataFrame, partition, order, value: str, modified: bool = False) -> DataFrame:
    """(count, value) per run (WIN-06); ``modified`` leaves the count null for
    singletons (WIN-07).  The run table keeps the group key and run number,
    so decoding can restore the order."""
    r = runs(df, partition, order, value)
    keys = [c for c in _cols(partition)]
    enc = r.groupBy(*keys, "run_no").agg(F.count(F.lit(1)).alias("n"), F.first(value).alias(value))
    if modified:
        enc = enc.withColumn("n", F.when(F.col("n") > 1, F.col("n")))
    return enc


#: Elements of an array that stands for part of a run or of a row's copies.
BLOCK = 1 << 20


def _blocks(n: Column, block: int) -> Column:
    """Sizes of the blocks that ``n`` elements fill, as (number, size)."""
    last = F.ceil(n / block) - 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda b: F.struct(
        b.alias("part"), F.least(n - b * block, F.lit(block).cast("bigint")).cast("int").alias("size"))))


def pack(df: DataFrame, partition, order, value: str, block: int = BLOCK) -> DataFrame:
    """Consecutive equal values packed into one list per run (WIN-05).  The
    list is rebuilt from (value, length) so no group is ever collected; a run
    longer than ``block`` comes in several rows, numbered by ``part``."""
    enc = run_length_encode(df, partition, order, value)
    enc = enc.withColumn("_b", F.explode(_blocks(F.col("n").cast("bigint"), block)))
    return enc.withColumns({"part": F.col("_b.part"), "pack": F.array_repeat(F.col(value), F.col("_b.size"))}).drop("_b")


def replicate(df: DataFrame, times: Column | str | int, name: str = "copy", block: int = BLOCK) -> DataFrame:
    """Each row ``times`` times (WIN-08 decode / duplicate / duplicateN), its
    copies numbered from 0; ``times <= 0`` yields no row.  Copies are exploded
    in two steps, blocks first, so no array holds all copies of a row."""
    n = F.lit(times) if isinstance(times, int) else (F.col(times) if isinstance(times, str) else times)
    rows = df.withColumn("_b", F.explode(_blocks(n.cast("bigint"), block)))
    rows = rows.select("*", F.posexplode(F.array_repeat(F.lit(0), F.col("_b.size"))).alias("_at", "_dummy"))
    return rows.withColumn(name, F.col("_b.part") * block + F.col("_at")).drop("_b", "_at", "_dummy")


def _with_group_size(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``_n``, the rows of the group; null keys are a group too."""
    n = df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(names)]).agg(F.count(F.lit(1)).alias("_n"))
    on = F.lit(True)
    for i, c in enumerate(names):
        on = F.col(c).eqNullSafe(F.col(f"_g{i}")) if i == 0 else on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return df.join(n, on).drop(*[f"_g{i}" for i in range(len(names))])


def nth_from_start_and_end(df: DataFrame, partition, order, value: str, k: int) -> DataFrame:
    """Last, next-to-last and k-th element of each group (WIN-09); absent
    positions are null (the reference raises).  Positions come from the key
    scan and group sizes from an aggregate, so no group is gathered."""
    keys = _cols(partition)
    x = _with_group_size(with_position(df, partition, order, "_a", keep=[value]), _names(partition))
    d = F.col("_n") - F.col("_a") + 1
    return x.groupBy(*keys).agg(
        F.max(F.when(d == 1, F.col(value))).alias("last"),
        F.max(F.when(d == 2, F.col(value))).alias("penultimate"),
        F.max(F.when(F.col("_a") == k, F.col(value))).alias("kth"))


def is_palindrome(df: DataFrame, partition: str, order, value: str) -> DataFrame:
    """Palindrome test per group (WIN-10) without collecting the group: rows at
    positions i and n-1-i are paired by an equi-join and compared.  Positions
    come from the measured key scan and sizes from an aggregate."""
    p = _with_group_size(with_position(df, partition, order, "_i", start=0, keep=[value]), [partition])
    a = p.select(partition, "_i", "_n", F.col(value).alias("_v"))
    b = p.select(F.col(partition).alias("_k"), (F.col("_n") - 1 - F.col("_i")).alias("_j"), F.col(value).alias("_m"))
    j = a.join(b, a[partition].eqNullSafe(b["_k"]) & (a["_i"] == b["_j"]))
    return j.groupBy(partition).agg(F.max("_n").cast("bigint").alias("n"),
                                    F.bool_and(F.col("_v").eqNullSafe(F.col("_m"))).alias("is_palindrome"))


def reverse_positions(df: DataFrame, partition: str, order, name: str = "pos") -> DataFrame:
    """Reverse of each group's sequence as new 0-based positions (WIN-10):
    ``n - 1 - i`` from the forward position and the group size."""
    p = _with_group_size(with_position(df, partition, order, "_i", start=0), [partition])
    return p.withColumn(name, (F.col("_n") - 1 - F.col("_i")).cast("bigint")).drop("_i", "_n")


def is_sorted(df: DataFrame, partition, order, value: str, descending: bool = False) -> DataFrame:
    """Whether ``value`` is non-decreasing (or non-increasing) along the order (WIN-11)."""
    f = key_scan(df, partition, order, prev_col=value, idx="_idx", prev="_prev")
    prev = F.col("_prev")
    ok = (prev <= F.col(value)) if not descending else (prev >= F.col(value))
    f = f.withColumn("_ok", F.coalesce(ok, F.lit(True)))
    return f.groupBy(*_cols(partition)).agg(F.bool_and("_ok").alias("is_sorted"))


def even_position_sum(df: DataFrame, partition, order, value: str, digits: int = 4) -> DataFrame:
    """Sum of values at even 0-based positions per group (WIN-12, FIL-07)."""
    p = with_position(df, partition, order, "_pos", start=0, keep=[value])
    return p.groupBy(*_cols(partition)).agg(
        fround(F.sum(F.when(F.col("_pos") % 2 == 0, F.col(value))), digits).alias("even_sum"))


# ---------------------------------------------------------------- joins ----

def rank_zip(a: DataFrame, b: DataFrame, a_value: str, b_value: str) -> DataFrame:
    """Pair the n-th smallest of ``a`` with the n-th smallest of ``b`` (JN-07);
    the longer side's tail has no partner and is dropped.  Equal values are
    told apart by a row number, so the range sort can split them over
    partitions; which of them comes first changes no pair of values."""
    def ranked(df, value, name):
        rows = df.select(F.col(value).alias(name)).where(F.col(name).isNotNull())
        tied = rows.withColumn("_tie", F.monotonically_increasing_id())
        return global_row_number(tied, [name, "_tie"], "rank").select("rank", name)

    return ranked(a, a_value, "a").join(ranked(b, b_value, "b"), "rank")


def positional_zip(a: DataFrame, a_order, b: DataFrame, b_order) -> DataFrame:
    """Zip two frames by position in their orders (JN-08)."""
    pa = global_row_number(a, a_order, "pos")
    pb = global_row_number(b, b_order, "pos")
    return pa.join(pb, "pos")


def asof(points: DataFrame, point: str, starts: DataFrame, at: str, name: str) -> DataFrame:
    """Add to each point the row of ``starts`` (as struct ``name``) with the
    largest ``at <= point``; null if there is none.

    Points and starts are sorted together and each point takes the last start
    so far: one range sort whatever the domain, however unevenly both lie in
    it.  Points with the same value are told apart by a tie-break, so they
    spread over partitions too."""
    from tessera.operators.scan import last_seen

    st = starts.select(F.col(at).alias("_at"), F.lit(0).alias("_rank"), F.lit(0).cast("bigint").alias("_tie"),
                       F.lit(None).alias("_p"), F.struct(*[F.col(c) for c in starts.columns]).alias("_s"))
    pt = points.select(F.col(point).alias("_at"), F.lit(1).alias("_rank"), F.monotonically_increasing_id().alias("_tie"),
                       F.struct(*[F.col(c) for c in points.columns]).alias("_p"), F.lit(None).alias("_s"))
    # Starts sort before points of the same value; null points come first, before any start.
    both = last_seen(pt.unionByName(st.where("_at is not null")), ["_at", "_rank", "_tie"], "_s", "_last").where("_rank = 1")
    return both.select(*[F.col("_p")[c].alias(c) for c in points.columns], F.col("_last").alias(name))


def range_lookup(points: DataFrame, point: str, intervals: DataFrame, lo: str, hi: str) -> DataFrame:
    """Join each point to the interval ``lo <= point < hi`` that holds it
    (JN-09), the intervals being disjoint (where some overlap, the one that
    begins last before the point is looked at): an as-of scan for the last
    interval that began, whose end then decides.  Points outside every
    interval get nulls."""
    both = asof(points, point, intervals.where(F.col(hi) > F.col(lo)), lo, "_iv")
    inside = F.col(point) < F.col("_iv")[hi]
    return both.select(*points.columns, *[F.when(inside, F.col("_iv")[c]).alias(c) for c in intervals.columns])


#: Distinct values of a block of the three-sum.
SUM_BLOCK = 2048


def _sweep(target, kind: str):
    """Rows of three sorted blocks -> triples ``x <= y <= z`` that sum to the
    target: for each x, ``target - x - y`` falls as y rises and is looked up in
    the third block by a sweep over both."""

    def run(frames):
        import numpy as np
        import pandas as pd

        dtype = np.float64 if kind == "double" else np.int64
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                xs, ys, zs = (np.asarray(v, dtype) for v in (r.xs, r.ys, r.zs))
                cx, cy, cz = (np.asarray(v, np.int64) for v in (r.cx, r.cy, r.cz))
                out = []
                for i, x in enumerate(xs):
                    first = i if r.i == r.j else 0
                    need = target - x - ys[first:]
                    at = np.minimum(np.searchsorted(zs, need), len(zs) - 1)
                    for j in np.flatnonzero((zs[at] == need) & (need >= ys[first:])):
                        y, z, a, b, c = ys[first + j], zs[at[j]], cx[i], cy[first + j], cz[at[j]]
                        if x == y == z:
                            n = a * (a - 1) * (a - 2) // 6
                        elif x == y:
                            n = a * (a - 1) // 2 * c
                        else:
                            n = a * (b * (b - 1) // 2) if y == z else a * b * c
                        if n:
                            out.append((x, y, z, n))
                yield pd.DataFrame(out, columns=["x", "y", "z", "n_triples"])

    return run


def _block_triples(ends: DataFrame, n: int, t: Column) -> DataFrame:
    """(i, j, k), i <= j <= k, of blocks (b, lo, hi) in order that can hold
    three values with sum ``t``."""
    pairs = ends.select(F.col("b").alias("i"), F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i"),
                        F.explode(F.sequence("b", F.lit(n - 1).cast("bigint"))).alias("j"))
    pairs = pairs.join(ends.select(F.col("b").alias("j"), F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j")), "j")
    pairs = pairs.select("i", "j", (t - F.col("hi_i") - F.col("hi_j")).alias("least"), (t - F.col("lo_i") - F.col("lo_j")).alias("most"))
    starts = ends.select("b", "lo")
    pairs = asof(asof(pairs, "least", starts, "lo", "from"), "most", starts, "lo", "upto").where("upto is not null")
    first = F.greatest(F.coalesce(F.col("from.b"), F.lit(0)), F.col("j"))
    return pairs.where(first <= F.col("upto.b")).select("i", "j", F.explode(F.sequence(first, F.col("upto.b"))).alias("k"))


def three_sum_values(values: DataFrame, column: str, target: int, block: int = SUM_BLOCK) -> DataFrame:
    """Triples ``x <= y <= z`` of values with ``x + y + z = target`` (JN-06),
    and how many index triples ``i < j < k`` of the input produce each.

    The distinct values, with their multiplicities, are cut by range into
    blocks of about ``block`` values.  Each pair of blocks bounds the third value to
    a range, whose blocks are found by two as-of scans over the block starts;
    only those triples of blocks meet, and a sweep finds the sums inside.  No
    pair of values is ever a row, and no join is a nested loop."""
    from tessera.session import materialize

    kind = "double" if dict(values.dtypes)[column] in ("double", "float") else "bigint"
    v = values.where(F.col(column).isNotNull()).groupBy(F.col(column).cast(kind).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    n = -(-v.count() // block)
    held = [F.min("x").alias("lo"), F.max("x").alias("hi"), F.array_sort(F.collect_list(F.struct("x", "c"))).alias("vs")]
    if n <= 1:  # one block, one triple of blocks
        blocks = v.agg(*held).select(F.lit(0).cast("bigint").alias("b"), "vs")
        triples = blocks.select(*[F.lit(0).cast("bigint").alias(k) for k in "ijk"])
    else:
        cut = v.repartitionByRange(n, "x").withColumn("b", F.spark_partition_id().cast("bigint"))
        blocks = materialize(cut.groupBy("b").agg(*held))
        triples = _block_triples(blocks.select("b", "lo", "hi"), n, F.lit(target).cast(kind))
    for at, x, c in (("i", "xs", "cx"), ("j", "ys", "cy"), ("k", "zs", "cz")):
        side = blocks.select(F.col("b").alias(at), F.col("vs.x").alias(x), F.col("vs.c").alias(c))
        triples = triples.join(side, at)
    triples = triples.repartition("i", "j", "k")
    out = triples.select("i", "j", "k", "xs", "cx", "ys", "cy", "zs", "cz").mapInPandas(
        _sweep(target, kind), f"x {kind}, y {kind}, z {kind}, n_triples bigint")
    same = dict(values.dtypes)[column]
    return out.select(*[F.col(x).cast(same).alias(x) for x in "xyz"], "n_triples")


def periodic_labels(df: DataFrame, column: str, rules: Sequence[tuple[str, int, int]],
                    name: str = "labels") -> DataFrame:
    """Names of the periodic rules ``(name, start, period)`` that fire for each
    value, in rule order (JN-10, FIL-08).  Rules are a parameter list, so the
    "join" is a projection; values no rule fires for are dropped."""
    hits = [F.when(((F.col(column) - F.lit(s)) % F.lit(p) == 0) & (F.col(column) >= F.lit(s)), F.lit(n))
            for n, s, p in rules]
    out = df.withColumn(name, F.filter(F.array(*hits), lambda x: x.isNotNull()))
    return out.where(F.size(name) > 0)
