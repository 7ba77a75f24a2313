"""SimHash near-duplicates (operator 5).

Fingerprints: ASCII upper case is lowered, words are runs of anything but
ASCII white space, every run of ``shingle`` words (repeats included) is hashed
with XXH64 (seed 42), and a fingerprint bit is set where over half the hashes
set it.  A text with fewer words is one shingle; one without words has
fingerprint zero.

Links: two fingerprints link when they differ in at most ``max_bits`` bits.
Pigeonhole: the 64 bits are split into ``blocks`` > ``max_bits`` blocks; close
fingerprints agree on at least ``blocks - max_bits`` of them, so they meet in
one of the keys made of that many blocks, and the distance is verified there.
More blocks give longer keys; the number is taken from the count of distinct
fingerprints so that a key of unrelated fingerprints holds about one (every
choice is exact).

Large groups: equal fingerprints are one node.  A key that more than ``TILE``
nodes share is cut into tiles, and each pair of tiles is one group, so no task
holds more than two tiles.  A group hands on a spanning star of each of its
connected components, never all its pairs.  Components are joined over groups
by alternating large-star and small-star rounds (Kiveris et al., 2014), each
written to the shared checkpoint folder.

Defined cases: null text counts as empty; a null id is allowed (it is never
the smallest id unless all of a component are null); repeated rows give
repeated results; an empty table gives an empty result; other columns are
ignored by :func:`components` and kept by :func:`deduplicate`.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import slices
from tessera.llm.common import fresh, materialize, row_identity, text_or_empty

TILE = 4096
SMALL = 16  # groups up to this size are compared by shifted arrays


def fingerprint(text: str, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    a, b = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(a), 1 << 16):
        part = np.fromiter((h(flat[x:y], 42) for x, y in zip(a[i:i + (1 << 16)], b[i:i + (1 << 16)])), np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(a), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                fp = np.array([fingerprint(t, shingle) for t in part.column("_t").to_pylist()], np.uint64)
                cols = {n: part.column(n) for n in part.schema.names if n != "_t"}
                yield pa.RecordBatch.from_pydict(cols | {"fp": pa.array(fp.view(np.int64))})

    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4, extra=()) -> DataFrame:
    """(_id, *extra, fp) for each row; ``extra`` are (name, Column) pairs."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("_id"), *[c.alias(n) for n, c in extra], text_or_empty(text_col).alias("_t"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name != "_t")
    assert schema.startswith(f"`_id` {kind}")
    return src.mapInArrow(_fingerprints(shingle), schema + ", fp long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Bit masks (as signed longs) of every choice of blocks - max_bits blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(one, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def choose_blocks(nodes: int, max_bits: int) -> int:
    """Fewest blocks whose keys have as many values as there are nodes."""
    blocks = max_bits + 1
    while blocks < 4 * max_bits + 4 and 64 * (blocks - max_bits) // blocks < max(1, nodes).bit_length():
        blocks += 1
    return blocks


def _stars(max_bits: int):
    """Sorted (key, tile pair, fp) rows -> spanning stars of the components
    inside each group."""

    def big(fp):
        import numpy as np

        rest, out = fp.copy(), []
        while len(rest) > 1:
            root, rest = rest[0], rest[1:]
            todo = [root]
            while todo and len(rest):
                near = np.bitwise_count(rest ^ todo.pop()) <= max_bits
                if near.any():
                    found = rest[near]
                    out.append(np.stack([np.full(len(found), root), found]))
                    todo.extend(found)
                    rest = rest[~near]
        return out

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = None

        def work(key, fp):
            change = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            bounds = np.concatenate(([0], change, [len(fp)]))
            size = np.diff(bounds)
            g = np.repeat(np.arange(len(size)), size)
            out = []
            small = np.repeat((size <= SMALL) & (size > 1), size)
            sg, sf = g[small], fp[small]
            for d in range(1, SMALL):
                if len(sf) <= d:
                    break
                near = (sg[d:] == sg[:-d])
                if not near.any():
                    break
                near &= np.bitwise_count(sf[d:] ^ sf[:-d]) <= max_bits
                out.append(np.stack([sf[:-d][near], sf[d:][near]]))
            for i in np.flatnonzero(size > SMALL):
                out += big(fp[bounds[i]:bounds[i + 1]])
            e = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.uint64)
            e = np.unique(e.view(np.int64), axis=1)
            return pa.RecordBatch.from_pydict({"u": pa.array(e[0]), "v": pa.array(e[1])})

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)
                            for n in ("c", "k", "i", "j")], axis=1)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if held is not None:
                key, fp = np.concatenate([held[0], key]), np.concatenate([held[1], fp])
            last = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if (key != key[-1]).any() else 0
            if last:
                yield work(key[:last], fp[:last])
            held = key[last:], fp[last:]
        if held is not None:
            yield work(*held)

    return run


def links(nodes: DataFrame, max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``), enough of
    them to connect all that the bit distance connects."""
    blocks = blocks or choose_blocks(nodes.count(), max_bits)
    masks = block_masks(blocks, max_bits)
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.lit(m).bitwiseAND(F.col("fp")) for m in masks])).alias("c", "k"))
    hot = keyed.groupBy("c", "k").count().where(F.col("count") > TILE).withColumn(
        "t", F.ceil(F.col("count") / F.lit(TILE / 2.0)).cast("int")).drop("count")
    tiles = keyed.join(hot, ["c", "k"], "left")
    b = F.pmod(F.xxhash64("fp"), F.col("t")).cast("int")
    pairs = F.when(F.col("t").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("t") - 1), lambda x: x != b),
                    lambda x: F.struct(F.least(x, b).alias("i"), F.greatest(x, b).alias("j"))))
    rows = tiles.select("c", "k", F.explode(pairs).alias("p"), "fp").select("c", "k", "p.i", "p.j", "fp")
    return (rows.repartition("c", "k", "i", "j").sortWithinPartitions("c", "k", "i", "j", "fp")
            .mapInArrow(_stars(max_bits), "u long, v long").distinct())


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for every
    node of ``edges`` (u, v) but the roots themselves."""
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        # Large star: every larger neighbour goes to the smallest neighbour.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # Small star: a node and its smaller neighbours go to the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def fingerprint_components(fps: DataFrame, lead, max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """(fp, lead): for each distinct fingerprint the least ``lead`` (a column
    or struct of ``fps``) of its component."""
    nodes = materialize(fps.groupBy("fp").agg(F.min(lead).alias("lead")))
    roots = star_components(links(nodes.select("fp"), max_bits, blocks))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "lead", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("lead").alias("least"))
    return named.join(least, "root").select("fp", F.col("least").alias("lead"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """(id_col, fingerprint, component_id) for each row of ``docs``."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle))
    found = fingerprint_components(fps, F.col("_id"), max_bits, blocks)
    return fps.join(found, "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("lead").alias("component_id"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, the one with the
    smallest id (null ids last, then by a hash of the row)."""
    name, key = fresh("__key", docs), row_identity(docs.columns)
    fps = materialize(fingerprints(docs, id_col, text_col, shingle, [("__key", key)]))
    lead = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("__key").alias("k"))
    stay = fingerprint_components(fps, lead, max_bits, blocks).select(F.col("lead.k").alias(name)).distinct()
    # Equal rows share a key: one of them stays, picked in each task before the texts are shuffled.
    once = docs.withColumn(name, key).dropDuplicates([name])
    return once.join(stay, name, "left_semi").select(*docs.columns)
