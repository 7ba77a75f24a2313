"""Row-level failure policies.

One contract: a frame carries an ``error`` column (null = the row is good),
computed once by the parsers in :mod:`tessera.functions.scalar`.  Policies
are then pure plan shapes:

* :func:`strict` — the first bad row fails the job (in-plan ``raise_error``,
  no extra counting pass);
* :func:`forgiving` — good rows and a quarantine frame (row + reason);
* :func:`forgive_only` — drop errors whose reason matches, fail on others;
* :func:`per_key_outcome` — per key, either a value or the error messages;
* :func:`all_or_nothing` — a struct of fields only when all are present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strict(df: DataFrame, error: str = "error") -> DataFrame:
    """Fail on the first bad row; otherwise the rows without the error column.

    The check is a filter whose condition raises for a bad row, so it runs
    inside the scan stage of whatever action consumes the frame."""
    ok = F.when(F.col(error).isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("strict parse failed: "), F.col(error))).cast("boolean"))
    return df.where(ok).drop(error)


def forgiving(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine rows with their reason).  Both derive from the
    same lazily-planned frame; cache it only if both are consumed."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def forgive_only(df: DataFrame, forgivable: Column, error: str = "error") -> DataFrame:
    """Drop bad rows for which ``forgivable`` holds; any other bad row fails."""
    bad = F.col(error).isNotNull()
    keep = (F.when(~bad, F.lit(True)).when(forgivable, F.lit(False))
            .otherwise(F.raise_error(F.concat(F.lit("unforgiven: "), F.col(error))).cast("boolean")))
    return df.where(keep).drop(error)


def per_key_outcome(df: DataFrame, key: str, value_agg: Column, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Per key: the reduced value when every row of the key is good
    (``ok(key, value)``), and for keys with failures one row per distinct
    message with its count (``errors(key, message, n)``).  Both are plain
    aggregates with map-side combining; no key's messages are gathered into
    one row, however many a hot key has."""
    g = df.groupBy(key).agg(F.count_if(F.col(error).isNotNull()).alias("_bad"), value_agg.alias("value"))
    ok = g.where("_bad = 0").select(key, "value")
    errors = (df.where(F.col(error).isNotNull()).groupBy(key, F.col(error).alias("message"))
              .agg(F.count(F.lit(1)).alias("n")))
    return ok, errors


def all_or_nothing(fields: dict[str, Column]) -> Column:
    """A struct of the fields when all are non-null, else null (ERR-06)."""
    present = None
    for c in fields.values():
        present = c.isNotNull() if present is None else present & c.isNotNull()
    return F.when(present, F.struct(*[c.alias(n) for n, c in fields.items()]))


def first_success(*alternatives: Column) -> Column:
    """Try alternatives in order (ERR-07)."""
    return F.coalesce(*alternatives)


def with_context(error: Column, *keys: str) -> Column:
    """Error text prefixed with the row's key values (STR-05)."""
    ctx = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    return F.when(error.isNotNull(), F.concat(F.lit("["), ctx, F.lit("] "), error))


def flatten_parsed(df: DataFrame, struct_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Lift a parser's struct fields (including ``error``) to columns."""
    return df.select(*keep, f"{struct_col}.*")
