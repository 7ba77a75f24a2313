"""MinHash near-duplicates over an LSH forest (operator 11).

Sets.  ASCII upper case is lowered, words are runs of anything but ASCII white
space, a document's set holds its distinct runs of ``shingle`` words (with
fewer words the whole sequence, without words nothing), each as the 64-bit hash
of its words' XXH64.  Two documents link when ``100 * |A & B| >= percent *
|A | B|``; equal sets are one node from the start.

Forest.  A signature has ``TREES * WIDTH`` min-hashes.  Each tree orders all
nodes by its own ``WIDTH`` of them, and the candidates of a node are those with
the longest common prefix.  The depth adapts to each region of an order: a
region is the nodes that share a prefix of ``DEPTHS[0]`` min-hashes; one with
more than ``REGION`` nodes is split by longer prefixes.  A region that is still
larger at full depth is linked to its smallest node unchecked, which only makes
the next step's groups coarser.  Inside a region a sketch of ``SKETCH``
min-hashes and the sizes of the sets discard what cannot link; a pair at the
least similarity has all of ``LEAST_MATCHES`` equal sketch values but for a
chance below 1e-9, and shares a region of the first depth but for 1e-10, one of
full depth (crowded regions only) but for 4e-5.

Exact check.  Nodes that the sketches connect form coarse groups.  Their full
sets, made anew from the texts, are compared inside chunks of bounded size; a
coarse group of several chunks gets hubs, some of its nodes that go to every
chunk, so its chunks connect.  The nodes that then stand outside the largest
component of their coarse group are compared with the whole group, chunk by
chunk.  So every candidate link is either inside a component or was refuted on
full sets, although no task holds more than a chunk and no group's pairs are
ever emitted.  Components come from alternating large and small stars.

Defined cases: null text counts as empty; a document without words has a
component of its own id; a null id is never the smallest id unless all of a
component are null, and ``kept`` is null for it; repeated rows give repeated
results (all kept if their id is the smallest); an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, text_or_empty
from tessera.llm.simhash import star_components
from tessera.llm.words import text_slices

TREES, WIDTH = 32, 8
DEPTHS = (4, 6, 8)
REGION = 2048
#: Every second min-hash, one byte of each; at 85 % some 109 agree, with a deviation of 4.
SKETCH, LEAST_MATCHES = TREES * WIDTH // 2, 82
#: Nodes and shingles of a chunk; hubs of a coarse group of several chunks.
CHUNK_NODES, CHUNK_SHINGLES, HUBS = 1024, 1 << 20, 64
SLICE = 1 << 19


def _constants():
    import numpy as np

    r = np.random.default_rng(11)
    return [r.integers(0, 1 << 32, TREES * WIDTH, np.uint32) | np.uint32(1) for _ in range(2)]


def shingle_sets(texts: list[bytes], shingle: int):
    """(flat, count): the sorted distinct shingle hashes of each text, one
    after another, and how many each has."""
    import numpy as np
    import xxhash

    words = [t.lower().split() for t in texts]  # bytes: ASCII case and white space only
    n = np.fromiter(map(len, words), np.int64, len(words))
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64, int(n.sum()))
    named = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
    h = named[ids]
    ends = np.cumsum(n)
    mul = np.uint64(0x9E3779B97F4A7C15)

    def mixed(x):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))

    total = len(h)
    if total >= shingle:
        runs = h[:total - shingle + 1].copy()
        for k in range(1, shingle):
            runs = runs * mul + h[k:total - shingle + 1 + k]
        runs = mixed(runs)
    flat, count = [], np.zeros(len(words), np.int64)
    for i, (k, end) in enumerate(zip(n.tolist(), ends.tolist())):
        if k >= shingle:
            own = np.sort(runs[end - k:end - shingle + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif k:
            x = np.uint64(k)
            with np.errstate(over="ignore"):
                for w in h[end - k:end]:
                    x = x * mul + w
            own = mixed(np.array([x], np.uint64))
        else:
            continue
        flat.append(own)
        count[i] = len(own)
    return (np.concatenate(flat) if flat else np.zeros(0, np.uint64)), count


def _sketches(shingle: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        mul, add = _constants()
        for batch in batches:
            for part, texts in text_slices(batch, "_t", SLICE):
                flat, count = shingle_sets(texts, shingle)
                some = np.flatnonzero(count)
                ends = np.cumsum(count)
                starts = ends - count
                low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
                value = np.zeros((len(mul), len(count)), np.uint32)
                if len(some):
                    at = starts[some]
                    for i, (a, b) in enumerate(zip(mul, add)):
                        value[i, some] = np.minimum.reduceat(high * a + low * b, at)
                # The upper half of a product: least values are small, so their own upper bits say little.
                short = ((value * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).T
                labels = np.ascontiguousarray(short)
                sketch = np.ascontiguousarray(short[:, ::2].astype(np.uint8))
                digest = [xxhash.xxh3_128_digest(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                key = np.frombuffer(b"".join(digest), ">i8").reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(count), pa.array(key[:, 0]), pa.array(key[:, 1]),
                     pa.array([x.tobytes() for x in labels], pa.binary()),
                     pa.array([x.tobytes() for x in sketch], pa.binary())],
                    names=["_id", "n", "s1", "s2", "labels", "sketch"])

    return run


def _region_stars(percent: int):
    """Rows sorted by region -> spanning stars of what sketches and sizes let
    pass inside each region."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def may_link(sketch, n, one, size):
            near = (sketch == one).sum(1) >= LEAST_MATCHES
            return near & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))

        def star(node, n, sketch):
            rest, out = np.arange(1, len(node)), []
            root, todo = 0, [0]
            while len(rest):
                if not todo:
                    root, rest = rest[0], rest[1:]
                    todo = [root]
                    continue
                x = todo.pop()
                near = may_link(sketch[rest], n[rest], sketch[x], n[x])
                if near.any():
                    found = rest[near]
                    out += [(node[root], node[i]) for i in found]
                    todo.extend(found.tolist())
                    rest = rest[~near]
            return out

        def work(key, node, n, sketch):
            change = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            size = np.diff(change)
            first = change[:-1][size == 2]  # most regions are pairs
            near = may_link(sketch[first], n[first], sketch[first + 1], n[first + 1])
            out = list(zip(node[first[near]], node[first[near] + 1]))
            for i in np.flatnonzero(size > 2):
                a, b = change[i], change[i + 1]
                out += star(node[a:b], n[a:b], sketch[a:b])
            e = np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)
            return pa.RecordBatch.from_pydict({"u": pa.array(e[:, 0]), "v": pa.array(e[:, 1])})

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "node", "n")]
            flat = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8)
            cols.append(flat.reshape(-1, SKETCH))
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            other = np.flatnonzero(cols[0] != cols[0][-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield work(*[c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield work(*held)

    return run


def _full_sets(shingle: int, extra: list[str]):
    """Rows with a text -> the same rows with its set; rows whose text has
    another set than asked for go, as does the same node again."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        last = None
        for batch in batches:
            for part, texts in text_slices(batch, "_t", SLICE):
                flat, count = shingle_sets(texts, shingle)
                ends = np.cumsum(count)
                keep, sets = [], []
                asked = zip(*(part.column(c).to_pylist() for c in ("s1", "s2", "node")))
                for i, (s1, s2, node) in enumerate(asked):
                    own = flat[ends[i] - count[i]:ends[i]]
                    digest = np.frombuffer(xxhash.xxh3_128_digest(own), ">i8")
                    if node != last and (digest[0], digest[1]) == (s1, s2):
                        keep.append(i)
                        sets.append(own.tobytes())
                        last = node
                rows = part.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in extra), pa.array(sets, pa.binary())], names=[*extra, "members"])

    return run


def _linked(flat, starts, size, one, n_values, percent):
    """Which of the sets (word numbers ``flat`` from ``starts`` on) link with ``one``."""
    import numpy as np

    flag = np.zeros(n_values, bool)
    flag[one] = True
    both = np.add.reduceat(flag[flat].astype(np.int32), starts)
    return 100 * both >= percent * (size + len(one) - both)


def _chunk_links(percent: int, probing: bool):
    """Rows sorted by group -> links on full sets.  A group's rows are its
    chunk and the nodes sent to it.  When ``probing``, the rows marked
    ``probe`` are compared with all of their group; else all rows are connected
    by breadth-first stars."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def work(rows):
            unique = {}
            for r in rows:  # a hub also stands in its own chunk
                if r["node"] not in unique or r["probe"]:
                    unique[r["node"]] = r
            rows = list(unique.values())
            if len(rows) < 2:
                return []
            sets = [np.frombuffer(r["members"], np.uint64) for r in rows]
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            values, flat = np.unique(np.concatenate(sets), return_inverse=True)
            ends = np.cumsum(size)
            starts = ends - size
            own = [flat[a:b] for a, b in zip(starts, ends)]
            node = [r["node"] for r in rows]
            if probing:
                out = []
                for i, r in enumerate(rows):
                    if r["probe"]:
                        near = np.flatnonzero(_linked(flat, starts, size, own[i], len(values), percent))
                        # One link to each component is enough.
                        out += {rows[j]["comp"]: (node[i], node[j]) for j in near if rows[j]["comp"] != r["comp"]}.values()
                return out
            rest, out, root, todo = np.arange(1, len(rows)), [], 0, [0]
            left = np.concatenate([own[i] for i in rest])
            at = np.cumsum(size[rest]) - size[rest]
            while len(rest):
                if not todo:
                    root, rest = rest[0], rest[1:]
                    todo = [root]
                else:
                    near = _linked(left, at, size[rest], own[todo.pop()], len(values), percent)
                    if not near.any():
                        continue
                    found = rest[near]
                    out += [(node[root], node[i]) for i in found]
                    todo.extend(found.tolist())
                    rest = rest[~near]
                if len(rest):
                    left = np.concatenate([own[i] for i in rest])
                    at = np.cumsum(size[rest]) - size[rest]
            return out

        held, key = [], None
        for batch in batches:
            out = []
            for r in (r for k in range(0, batch.num_rows, 256) for r in batch.slice(k, 256).to_pylist()):
                if key != (r["root"], r["chunk"], r["block"]):
                    out += work(held)
                    held, key = [], (r["root"], r["chunk"], r["block"])
                held.append(r)
            e = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({"u": pa.array(e[:, 0]), "v": pa.array(e[:, 1])})
        e = np.array(work(held), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_pydict({"u": pa.array(e[:, 0]), "v": pa.array(e[:, 1])})

    return run


def candidate_links(nodes: DataFrame, percent: int = 85, depths=DEPTHS, region: int = REGION) -> DataFrame:
    """(u, v): enough candidate links between the rows of ``nodes`` (node, n,
    labels, sketch) to connect all that link."""

    def keyed(src, depth):
        label = F.substring("labels", F.col("t") * (2 * WIDTH) + 1, F.lit(2 * depth))
        return src.select("t", "node", F.xxhash64("t", label).alias("key"))

    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t")
    rows = keyed(nodes.select("node", "labels", trees), depths[0])
    checked, unchecked = [], None
    for k, depth in enumerate(depths):
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
        shared = materialize(rows.join(sizes, "key"))
        checked.append(shared.where(F.col("size") <= region).select("key", "node"))
        crowded = shared.where(F.col("size") > region)
        if crowded.isEmpty():
            break
        if k + 1 < len(depths):
            rows = keyed(crowded.select("t", "node").join(nodes.select("node", "labels"), "node"), depths[k + 1])
        else:
            least = crowded.groupBy("key").agg(F.min("node").alias("v"))
            unchecked = crowded.join(least, "key").where("node <> v").select(F.col("node").alias("u"), "v")
    rows = checked[0]
    for more in checked[1:]:
        rows = rows.unionByName(more)
    links = (rows.join(nodes.select("node", "n", "sketch"), "node").repartition("key")
             .sortWithinPartitions("key", "node").mapInArrow(_region_stars(percent), "u long, v long"))
    return links if unchecked is None else links.unionByName(unchecked)


def _where_in(docs: DataFrame, id_col: str, wanted: DataFrame, wanted_col: str) -> DataFrame:
    """Rows of ``docs`` whose id may be in ``wanted``, by a bit map of at most
    2**27 bits (a table of 2**21 rows at most, so it is broadcast)."""
    bits = 1 << min(27, max(16, (16 * wanted.count()).bit_length()))

    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(bits))

    def bit(c):
        return F.call_function("shiftleft", F.lit(1).cast("long"), (place(c) % 64).cast("int"))

    words = wanted.groupBy(F.floor(place(wanted_col) / 64).alias("_w")).agg(F.bit_or(bit(wanted_col)).alias("_m"))
    found = docs.withColumn("_w", F.floor(place(id_col) / 64)).join(F.broadcast(words), "_w")
    return found.where(F.col("_m").bitwiseAND(bit(id_col)) != 0).drop("_w", "_m")


def exact_links(src: DataFrame, nodes: DataFrame, coarse: DataFrame, shingle: int = 5, percent: int = 85,
                chunk_nodes: int = CHUNK_NODES, chunk_shingles: int = CHUNK_SHINGLES, hubs: int = HUBS) -> DataFrame:
    """(u, v): links on full sets that connect, inside each coarse group (node,
    root), all nodes that links connect.  ``src`` has _id and _t."""
    roots = coarse.select("root").distinct()
    members = coarse.unionByName(roots.select(F.col("root").alias("node"), "root"))
    members = members.join(nodes.select("node", "n", "s1", "s2", "lead"), "node")
    chunks = F.ceil(F.greatest(F.col("rows") / chunk_nodes, F.col("shingles") / chunk_shingles)).cast("int")
    totals = members.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")).select(
        "root", "rows", chunks.alias("chunks"))
    members = materialize(members.join(totals, "root").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))

    def compared(rows, groups, probing):
        """``rows`` of members; ``groups``: array of (chunk, block, probe) each goes to."""
        extra = ["root", "node", "comp", "groups"]
        asked = rows.withColumn("groups", groups).select(*extra, "s1", "s2", "lead")
        texts = _where_in(src, "_id", asked, "lead")
        joined = texts.join(asked, texts["_id"].eqNullSafe(asked["lead"])).select(*extra, "s1", "s2", "_t")
        schema = ("root long, node long, comp long, groups array<struct<chunk:int,block:int,probe:boolean>>, "
                  "members binary")
        sets = joined.mapInArrow(_full_sets(shingle, extra), schema)
        rows = sets.select("root", "node", "comp", F.explode("groups").alias("g"), "members")
        rows = rows.select("root", "node", "comp", "g.chunk", "g.block", "g.probe", "members")
        keys = ["root", "chunk", "block"]
        return rows.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(
            _chunk_links(percent, probing), "u long, v long").distinct()

    def group(chunk, block, probe):
        return F.struct(chunk.alias("chunk"), block.cast("int").alias("block"), probe.alias("probe"))

    no, zero = F.lit(False), F.lit(0)
    every = F.transform(F.sequence(zero, F.col("chunks") - 1), lambda c: group(c, zero, no))
    hub = (F.col("chunks") > 1) & (F.pmod(F.xxhash64(F.lit("hub"), "node"), F.col("rows")) < hubs)
    first = materialize(compared(members.withColumn("comp", F.lit(None).cast("long")),
                                 F.when(hub, every).otherwise(F.array(group(F.col("chunk"), zero, no))), False))
    large = members.where("chunks > 1")
    if large.isEmpty():
        return first
    found = star_components(first.join(large.select(F.col("node").alias("u")), "u", "left_semi"))
    large = large.join(found.select("node", F.col("root").alias("comp")), "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    sizes = large.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("root").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"),
                                     (F.sum("k") - F.max("k")).alias("others"))
    # The others, in blocks, go to every chunk; the chunk's own rows to every block.
    large = materialize(large.join(main.where("others > 0"), "root"))
    if large.isEmpty():
        return first
    blocks = F.ceil(F.col("others") / chunk_nodes).cast("int")
    own = F.transform(F.sequence(zero, blocks - 1), lambda b: group(F.col("chunk"), b, no))
    block = F.pmod(F.xxhash64(F.lit("block"), "node"), blocks)
    sent = F.transform(F.sequence(zero, F.col("chunks") - 1), lambda c: group(c, block, F.lit(True)))
    groups = F.when(F.col("comp") != F.col("main"), F.concat(F.filter(own, lambda g: g["block"] != block), sent)).otherwise(own)
    return materialize(first.unionByName(compared(large, groups, True)))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 85,
               depths=DEPTHS, region: int = REGION, **chunks) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for each row of ``docs``."""
    src = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
    kind = src.schema["_id"].dataType.simpleString()
    sets = materialize(src.mapInArrow(
        _sketches(shingle), f"_id {kind}, n long, s1 long, s2 long, labels binary, sketch binary"))
    # A node is a distinct set; its number is written with it, so all readers see the same.
    nodes = materialize(sets.where("n > 0").groupBy("s1", "s2").agg(
        F.min("_id").alias("lead"), F.first("n").alias("n"), F.first("labels").alias("labels"),
        F.first("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()))
    coarse = star_components(candidate_links(nodes, percent, depths, region))
    roots = star_components(exact_links(src, nodes, coarse, shingle, percent, **chunks))
    named = nodes.join(roots, "node", "left").select("s1", "s2", "lead", F.coalesce("root", "node").alias("root"))
    # Most components are one node: only the others are gathered by their root.
    least = named.groupBy("root").agg(F.min("lead").alias("least"))
    named = named.join(least, "root").select("s1", "s2", "least")
    joined = sets.where("n > 0").join(named, ["s1", "s2"]).select("_id", "n", "least").unionByName(
        sets.where("n = 0").select("_id", "n", F.col("_id").alias("least")))
    return joined.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"),
                         (F.col("_id") == F.col("least")).alias("kept"))
