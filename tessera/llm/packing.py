"""Best-fit packing (operator 8): best-fit decreasing into sequences of a
fixed length.

A document's ids are followed by an end id; documents longer than a sequence
are cut into full pieces, the first piece being the shorter one.  Best-fit
decreasing only looks at lengths, and there are at most ``capacity`` of them,
so the number of pieces of each length (a distributed count) decides the whole
packing.  :func:`best_fit` runs over that histogram on the driver: pieces of
one length are placed in runs, always into the tightest open bins, found by a
segment tree over remaining capacities (leaf r: open bins with r free places).
Its input is at most ``capacity`` numbers and its output a few spans of ranks
per length, whatever the corpus size.  Pieces get their rank by a range sort
on (length, id, ...), which also splits a length that many pieces share, and
look up the span their rank falls in.

Defined cases: null text is empty (one sequence place, its end id); repeated
rows are packed as often as they occur; a null id stays null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import chunks as C
from tessera.llm.common import materialize, text_or_empty
from tessera.operators.ordered import global_row_number


class RemainingTree:
    """Segment tree over remaining capacities 0..capacity holding the number
    of open bins at each; finds the tightest capacity that still fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.sum = [0] * (2 * self.leaves)

    def add(self, r: int, n: int) -> None:
        i = r + self.leaves
        while i:
            self.sum[i] += n
            i //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest r >= need with an open bin: climb until a right
        neighbour holds bins, then go down to its leftmost one."""
        i = need + self.leaves
        if not self.sum[i]:
            while i > 1 and not (i % 2 == 0 and self.sum[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.sum[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over pieces counted by length.

    Returns spans (first position, number, sequence of the first, sequence
    step, offset), where positions number all pieces by falling length: the
    piece at first + i lies in sequence + i * step at that offset.  A bin that
    takes one piece is the tightest one for the next piece of that length, so
    it is filled as far as it goes before another is touched; runs of equal
    bins are handled together, one layer of pieces at a time."""
    tree, at = RemainingTree(capacity), {}  # at: r -> [(first bin, bins)]
    spans, bins, pos = [], 0, 0

    def put(r: int, first: int, n: int) -> None:
        if n:
            at.setdefault(r, []).append((first, n))
            tree.add(r, n)

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            r = tree.tightest(size)
            if r is None:
                fits = capacity // size
                r, first, n = capacity, bins, -(-left // fits)
                bins += n
            else:
                first, n = at[r].pop()
                tree.add(r, -n)
            fits = r // size
            full = min(n, left // fits)
            for layer in range(fits if full else 0):
                spans.append((pos, full, first, 1, capacity - r + layer * size))
                pos += full
            left -= full * fits
            put(r - fits * size, first, full)
            if full < n and left and left < fits:  # the last pieces share one bin
                for layer in range(left):
                    spans.append((pos, 1, first + full, 1, capacity - r + layer * size))
                    pos += 1
                put(r - left * size, first + full, 1)
                full, left = full + 1, 0
            put(r, first + full, n - full)
    return spans


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches):
        import zlib

        import pyarrow as pa

        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for part in C.slices(batch):
                docs, piece, start, length, crc, raw = [], [], [], [], [], []
                for doc, ids in zip(part.column(0).to_pylist(), C.ids_of(path, part.column(1).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    edges = list(range(n % capacity or capacity, n + 1, capacity))
                    a = 0
                    for k, b in enumerate(edges):
                        docs.append(doc)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a:4 * b]))
                        if with_ids:
                            raw.append(ids[4 * a:4 * b])
                        a = b
                cols = {"_id": pa.array(docs, part.column(0).type), "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array(raw, pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset) for each
    piece; ``with_ids`` adds the piece's ids (little-endian unsigned 32-bit)."""
    path = tokenizer_path or C.default_path()
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    cut = materialize(docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
                      .mapInArrow(_pieces(path, capacity, end_id, with_ids), schema))
    # At most ``capacity`` rows.
    sizes = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    spans = best_fit(sizes, capacity)
    plan = spark.sparkContext.broadcast((spans, [s[0] for s in spans]))
    order = [F.desc("length"), "_id", "piece", "start", "ids_crc32"]
    ranked = global_row_number(cut, order, name="_pos", start=0)

    def place(batches):
        import numpy as np
        import pyarrow as pa

        spans, firsts = plan.value
        table = np.array(spans, np.int64).reshape(-1, 5)
        for batch in batches:
            p = batch.column("_pos").to_numpy(zero_copy_only=False)
            s = table[np.searchsorted(table[:, 0], p, "right") - 1] if len(table) else np.zeros((0, 5), np.int64)
            cols = {n: batch.column(n) for n in batch.schema.names if n != "_pos"}
            yield pa.RecordBatch.from_pydict(cols | {
                "sequence_id": pa.array(s[:, 2] + (p - s[:, 0]) * s[:, 3]), "offset": pa.array(s[:, 4])})

    out = ranked.mapInArrow(place, schema + ", sequence_id long, offset long")
    return out.withColumnRenamed("_id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, from
    ``pack(..., with_ids=True)``.  A group is one sequence, so it holds at most
    ``capacity`` ids."""
    return (pieces.groupBy("sequence_id")
            .agg(F.sum("length").alias("length"),
                 F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
            .select("sequence_id", "length", F.concat_ws("", F.transform("_p", lambda p: F.hex(p["ids"]))).alias("_x"))
            .select("sequence_id", "length", F.unhex("_x").alias("ids")))
