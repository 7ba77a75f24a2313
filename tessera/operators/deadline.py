"""Calls with a time limit (STR-09).

The caller's function is started on every row of a block at once, each in a
thread of its own; when the limit has passed, the rows whose call has ended
keep its value or its error and the others are marked as timed out.  A thread
cannot be stopped from outside, so a late call runs on in the background of
its Python worker, its result unused; the block size bounds how many.
Blocks follow one another inside a partition, so a partition of n rows takes
at most ``ceil(n / block)`` limits."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame

DONE, FAILED, TIMED_OUT = "done", "failed", "timed out"


def _call_all(fn: Callable, items: list, seconds: float) -> list[tuple]:
    """(status, value, error) of each item after at most ``seconds``."""
    import threading
    import time

    out: list[tuple | None] = [None] * len(items)

    def call(i, x):
        try:
            found = (DONE, fn(x), None)
        except Exception as e:  # noqa: BLE001 - the item's own failure is its result
            found = (FAILED, None, f"{type(e).__name__}: {e}")
        out[i] = found

    threads = [threading.Thread(target=call, args=(i, x), daemon=True) for i, x in enumerate(items)]
    end = time.monotonic() + seconds
    for t in threads:
        t.start()
    for t in threads:
        t.join(max(0.0, end - time.monotonic()))
    late = (TIMED_OUT, None, f"not done within {seconds:g} s")
    return [late if r is None else r for r in list(out)]


def call_within(df: DataFrame, column: str, fn: Callable, kind: str, seconds: float, block: int = 64) -> DataFrame:
    """The rows of ``df`` but for ``column``, with (status, value, error) of
    ``fn`` called on it: ``value`` has the Spark type ``kind``.  Null cells are
    handed over as ``None``."""
    keep = [c for c in df.columns if c != column]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep),
                        f"status string, value {kind}, error string"])

    def run(frames):
        for pdf in frames:
            for k in range(0, len(pdf), block):
                part = pdf.iloc[k:k + block]
                found = _call_all(fn, part[column].tolist(), seconds)
                out = part[keep].copy()
                for j, name in enumerate(("status", "value", "error")):
                    out[name] = pd.Series([r[j] for r in found], index=part.index, dtype=object)
                yield out

    return df.select(*keep, column).mapInPandas(run, schema)
