"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize
from tessera.sources.tables import table

__all__ = ["materialize", "table", "text_or_empty", "row_hash", "hash_sample", "fresh", "row_identity"]


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def row_hash(*cols) -> Column:
    """64-bit hash that names a row by its contents; equal rows share it."""
    return F.xxhash64(*cols)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_identity(columns) -> Column:
    """128 bits that tell rows apart, also rows that hold the same values in
    other columns beside nulls, which a hash passes over."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *nulls, *columns).alias("b"))


def hash_sample(df: DataFrame, key: str, n: int, total: int | None = None) -> DataFrame:
    """The (at most) ``n`` rows with the smallest value of the hash column
    ``key`` folded to 30 bits.  Where there are many more rows, only those
    under a bound that about ``4 * n`` rows meet are sorted, so what the tasks
    hand on does not grow with their number."""
    total = df.count() if total is None else total
    h = F.pmod(F.col(key), F.lit(1 << 30))
    if total > 8 * n:
        df = df.where(h < int((1 << 30) * 4 * n / total) + 1)
    return df.orderBy(h, key).limit(n)
