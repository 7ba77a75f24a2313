"""Aggregations.

All of these are single ``groupBy().agg()`` / ``agg()`` plans: Catalyst plans a
partial (map-side) aggregate, one hash exchange on the grouping keys, and a
final aggregate, so the shuffle carries one partial row per key per input
partition rather than the input rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import fround


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mean_stddev(df: DataFrame, keys: Sequence[str] | str | None, value: str,
                digits: int | None = None) -> DataFrame:
    """Mean and sample standard deviation of ``value`` per key (AGG-01) or
    over all rows when ``keys`` is empty (AGG-02).  A one-row group has a
    null deviation, as ``stddev_samp`` defines it."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    mean = F.avg(value)
    std = F.stddev_samp(value)
    if digits is not None:
        mean, std = fround(mean, digits), fround(std, digits)
    aggs = [mean.alias("mean"), std.alias("stddev")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def conditional_means(df: DataFrame, value: str, cases: dict[str, Column],
                      digits: int | None = None) -> DataFrame:
    """One mean per filter, all in one scan (AGG-03): ``avg(when(cond, v))``
    replaces one filtered aggregate per class."""
    out = []
    for name, cond in cases.items():
        e = F.avg(F.when(cond, F.col(value)))
        out.append((fround(e, digits) if digits is not None else e).alias(name))
    return df.agg(*out)


def rate(flag: Column) -> Column:
    """Mean of a 0/1 indicator = share of rows where ``flag`` holds (AGG-06)."""
    return F.avg(F.when(flag, F.lit(1)).otherwise(F.lit(0)))


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Null count of every column in one pass (AGG-13, PRJ-09)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def describe_long(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """``describe()`` in long, typed form (AGG-11): one row per column with
    count, mean, stddev, min, max.  One aggregate pass over all columns, then
    a ``stack`` to unpivot the single result row."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), fround(F.avg(x), digits).alias(f"{c}__mean"),
                 fround(F.stddev_samp(x), digits).alias(f"{c}__stddev"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in columns)
    return wide.selectExpr(
        f"stack({len(columns)}, {parts}) as (column_name, n, mean, stddev, min_value, max_value)")


#: Values strictly between two pivots that the last pass of a selection may
#: gather into one array.
GATHERED = 8192
#: Accuracy of the pivots: about one in so many ranks.
PIVOT_ACCURACY = 10_000


def _narrow(x: DataFrame, ranks: dict, total: int) -> dict:
    """For each name its interval (lo, hi, below, count): the element of that
    rank lies strictly between lo and hi (null: unbounded), ``below`` elements
    come before it and ``count`` lie in it; or its value, as ``("is", value)``.

    Each pass takes two pivots about the wanted rank from a quantile sketch of
    bounded size, then counts exactly what lies below and at them.  The sketch
    only proposes; a wrong proposal costs a pass.  Pivots are elements, so
    every pass leaves fewer, and equal values are counted, never sorted."""
    found = {name: (None, None, 0, total) for name in ranks}
    while todo := [n for n, s in found.items() if s[0] != "is" and s[3] > GATHERED]:
        def inside(name):
            lo, hi = found[name][:2]
            cond = F.lit(True) if lo is None else F.col("x") > F.lit(lo)
            return cond if hi is None else cond & (F.col("x") < F.lit(hi))

        def pivots(name):
            _, _, below, count = found[name]
            at = (ranks[name] - below) / count
            about = [min(1.0, max(0.0, at + d)) for d in (-2 / PIVOT_ACCURACY, 2 / PIVOT_ACCURACY)]
            return F.percentile_approx(F.when(inside(name), F.col("x")), about, PIVOT_ACCURACY).alias(name)

        proposed = x.agg(*[pivots(n) for n in todo]).first()
        counts = x.agg(*[F.count_if(inside(n) & test(F.col("x"), F.lit(p))).alias(f"{n}_{i}_{j}")
                         for n in todo for i, p in enumerate(proposed[n])
                         for j, test in enumerate((lambda a, b: a < b, lambda a, b: a <= b))]).first()
        for n in todo:
            lo, hi, below, count = found[n]
            k = ranks[n] - below
            left, done = 0, False
            for i, p in enumerate(proposed[n]):
                under, upto = counts[f"{n}_{i}_0"], counts[f"{n}_{i}_1"]
                if under < k <= upto:
                    found[n], done = ("is", p), True
                elif k <= under and not done:
                    found[n], done = (lo, p, below + left, under - left), True
                elif not done:
                    lo, left = p, upto
            if not done:
                found[n] = (lo, hi, below + left, count - left)
    return found


def quartile_summary(df: DataFrame, column: str) -> DataFrame:
    """``summary()`` statistics of one column (AGG-12), exact at any size.

    The quartile at fraction q is the element whose rank is ``ceil(q * n)``
    (at least 1) among the n non-null values.  It is selected by counting
    passes (:func:`_narrow`): no sort, no shuffle of rows and no checkpoint;
    the last few thousand candidates are gathered by the final aggregate."""
    x = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    total = x.count()
    ranks = {name: max(1, math.ceil(q * total)) for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))}

    def value(name, state):
        if state[0] == "is":
            return F.max(F.lit(state[1])).alias(name)
        lo, hi, below, _ = state
        here = F.lit(True) if lo is None else F.col("x") > F.lit(lo)
        here = here if hi is None else here & (F.col("x") < F.lit(hi))
        gathered = F.sort_array(F.collect_list(F.when(here, F.col("x"))))
        return F.try_element_at(gathered, F.lit(ranks[name] - below)).alias(name)

    at = [value(n, s) for n, s in _narrow(x, ranks, total).items()]
    return x.agg(F.count("x").alias("n"), fround(F.avg("x"), 6).alias("mean"), fround(F.stddev_samp("x"), 6).alias("stddev"),
                 F.min("x").alias("min_value"), *at, F.max("x").alias("max_value"))


def pairwise_corr(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair ``x != y`` (AGG-14).

    One aggregate computes each unordered pair once; a ``stack`` emits both
    orders.  ``corr`` skips rows where either side is null (``stat.corr``
    would count them as zero)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[fround(F.corr(a, b), digits).alias(f"{a}__{b}") for a, b in pairs])
    parts = []
    for a, b in pairs:
        parts += [f"'{a}', '{b}', `{a}__{b}`", f"'{b}', '{a}', `{a}__{b}`"]
    return wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (x, y, corr)")


def rms_stats(df: DataFrame, value: str, lo: float = 0.0, hi: float = 1.0, keys=()) -> DataFrame:
    """Mean and root mean square of values inside ``[lo, hi]`` (FIL-06, AGG-20)."""
    x = F.col(value)
    kept = df.where(x.between(lo, hi))
    aggs = [F.count(x).alias("n"), fround(F.avg(x), 6).alias("mean"),
            fround(F.sqrt(F.avg(x * x)), 6).alias("rms")]
    return kept.groupBy(*keys).agg(*aggs) if keys else kept.agg(*aggs)


def map_reduce(df: DataFrame, mapper: dict[str, Column], key: str, reducer, zero=None,
               result: str = "result") -> DataFrame:
    """Generic map-reduce (AGG-21, AGG-22).

    ``mapper`` is a projection producing the ``key`` and value columns;
    ``reducer`` is an aggregate-building function ``Column -> Column`` (for
    example ``F.sum``) — Spark combines it map-side before the shuffle, which
    is what the reference's reducer pool approximates.  ``zero`` is the fold's
    initial value, returned for keys whose reduction is null."""
    mapped = df.select(*[e.alias(n) for n, e in mapper.items()])
    value = [n for n in mapper if n != key][0]
    agg = reducer(F.col(value))
    if zero is not None:
        agg = F.coalesce(agg, F.lit(zero))
    return mapped.groupBy(key).agg(agg.alias(result))


def sum_with_uncertainty(df: DataFrame, keys: Sequence[str], mu: str, sigma: str | None = None,
                         delta: str | None = None, digits: int = 6) -> DataFrame:
    """Sum of uncertain values (AGG-29): means add; Gaussian errors add in
    quadrature; bounded errors add linearly."""
    aggs = [fround(F.sum(mu), digits).alias("mu")]
    if sigma:
        aggs.append(fround(F.sqrt(F.sum(F.col(sigma) * F.col(sigma))), digits).alias("sigma"))
    if delta:
        aggs.append(fround(F.sum(delta), digits).alias("delta"))
    return df.groupBy(*keys).agg(*aggs)


def last_wins(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Index rows by key keeping the last duplicate (AGG-31): ``max_by`` on
    the ordering struct is a streaming aggregate, no sort or window."""
    o = F.struct(*[F.col(c) for c in order])
    picked = F.max_by(F.struct(*[F.col(c) for c in columns]), o).alias("_last")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"_last.{c}").alias(c) for c in columns])
