"""Projections, filters, joins, set operations and sorts.

These are thin, explicit compositions of DataFrame methods; what they add
is the reference's *semantics* (unknown names dropped, first price wins,
unmatched lookups reported as errors, right-biased map union, rank-list
orders) in a form Catalyst can still optimise end to end.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# ------------------------------------------------------------ projections --


def select_positions(df: DataFrame, indices: Sequence[int]) -> DataFrame:
    """Columns by 0-based position, in the caller's order (PRJ-02)."""
    return df.select(*[df.columns[i] for i in indices])


def select_known(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns by name; names the frame does not have are dropped (PRJ-03)."""
    have = set(df.columns)
    return df.select(*[n for n in names if n in have])


def optional_column(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column if present, else a typed null (PRJ-04)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def snake_case(name: str) -> str:
    """camelCase -> snake_case: an underscore before every upper-case letter
    or digit, then lower case (PRJ-05)."""
    return re.sub(r"([A-Z0-9])", r"_\1", name).lower().lstrip("_")


def rename_columns(df: DataFrame, overrides: Mapping[str, str] | None = None,
                   rule=snake_case, prefix: Mapping[str, str] | None = None) -> DataFrame:
    """Rename every column by ``rule`` unless ``overrides`` names it; columns
    listed in ``prefix`` get ``<prefix>_<name>`` (the ``$x_$c`` pattern)."""
    overrides, prefix = dict(overrides or {}), dict(prefix or {})
    mapping = {}
    for c in df.columns:
        new = overrides.get(c) or rule(c)
        if c in prefix:
            new = f"{prefix[c]}_{new}"
        mapping[c] = new
    return df.withColumnsRenamed(mapping)


def row_as_map(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Row as a ``map<string,string>`` of column -> value (PRJ-07)."""
    cols = list(columns or df.columns)
    kv = []
    for c in cols:
        kv += [F.lit(c), F.col(c).cast("string")]
    return F.create_map(*kv)


def flat_map(df: DataFrame, keep: Sequence[str], outputs: Mapping[str, Column], kind: str = "kind",
             value: str = "value") -> DataFrame:
    """Each row to several rows, one per named expression (PRJ-08)."""
    arr = F.array(*[F.struct(F.lit(k).alias(kind), e.alias(value)) for k, e in outputs.items()])
    return df.select(*keep, F.inline(arr))


# ---------------------------------------------------------------- filters --


def find_first(df: DataFrame, cond: Column | str, order: Sequence, what: str = "row") -> DataFrame:
    """The first row (in ``order``) matching ``cond``; an error when none
    does (FIL-05).  The emptiness check stays inside the plan: a one-row
    frame is left-joined to the (at most one-row) hit and a filter raises
    when nothing matched, so no separate driver-side action is needed."""
    hit = df.where(cond).orderBy(*order).limit(1).withColumn("_found", F.lit(True))
    one = df.sparkSession.range(1).select(F.lit(1).alias("_one"))
    j = one.join(hit.withColumn("_one", F.lit(1)), "_one", "left")
    ok = F.coalesce(F.col("_found"), F.raise_error(F.lit(f"no {what} matches")).cast("boolean"))
    return j.where(ok).drop("_one", "_found")


def split_by(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """``filter`` and ``filterNot`` (FIL-10).  Rows where the predicate is
    null belong to neither side, as in SQL."""
    return df.where(cond), df.where(~cond)


# ------------------------------------------------------------------ joins --


def first_per_key(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """One value per key: the first in ``order`` wins (JN-02's price rule),
    as a ``min_by`` aggregate rather than a sort."""
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(key).agg(F.min_by(F.col(value), o).alias(value))


def lookup(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Equi-join lookup on ``key``.  No broadcast hint: the optimizer (and
    AQE at run time, from measured sizes) chooses broadcast when the lookup
    side is small and a shuffle join when it is not."""
    return left.join(right, key, how)


def lookup_errors(left: DataFrame, right: DataFrame, key: str, what: str = "entry") -> DataFrame:
    """Rows of ``left`` without a partner, as (key, error) (JN-03)."""
    missing = left.join(right.select(key), key, "left_anti")
    return missing.select(key, F.concat(F.lit(f"no {what} matching "), F.col(key).cast("string")).alias("error"))


def weighted_product(a: DataFrame, b: DataFrame, wa: str, wb: str, name: str = "weight") -> DataFrame:
    """Cartesian product of two weighted category lists, weights multiplied
    (JN-05): the product is the operator, so its output is |a| x |b| rows.
    The optimizer broadcasts a side whose size it knows to be small and else
    uses the distributed product."""
    return a.crossJoin(b).withColumn(name, F.col(wa) * F.col(wb))


# ---------------------------------------------------------------- set ops --


def map_union(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Key/value union where the right side wins per key (SET-04)."""
    l, r = left.select(key, F.col(value).alias("_l")), right.select(key, F.col(value).alias("_r"))
    return l.join(r, key, "full").select(key, F.coalesce("_r", "_l").alias(value))


# ------------------------------------------------------------------ sorts --


def rank_list_position(col, ranks: Sequence[str]) -> Column:
    """1-based position of the value in an explicit rank list, 0 when absent
    (SRT-05)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_position(F.array(*[F.lit(r) for r in ranks]), c)


def numeric_string_order(col) -> list[Column]:
    """Sort keys ordering digit strings of any length numerically (SRT-04):
    shorter first, then lexicographic.  Assumes no leading zeros."""
    c = F.col(col) if isinstance(col, str) else col
    return [F.length(c), c]


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """First ``k`` rows in a total order (SRT-03/06); planned as
    ``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge)."""
    return df.orderBy(*order).limit(k)


def everything() -> W:
    return W.partitionBy()
