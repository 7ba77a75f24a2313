"""Texts of Arrow batches as bytes, in slices of bounded size."""

from __future__ import annotations

SLICE_BYTES = 4 << 20


def text_slices(batch, column: str, n_bytes: int = SLICE_BYTES):
    """(part, texts) of an Arrow batch: row ranges whose texts hold at most
    ``n_bytes`` together (a longer text alone), and those texts as bytes."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = upto[start] - size[start]
        stop = max(start + 1, int(np.searchsorted(upto, base + n_bytes, side="right")))
        part = batch.slice(start, stop - start)
        yield part, part.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
        start = stop
