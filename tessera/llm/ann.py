"""Approximate nearest neighbours (operator 4) with learned partitions.

After Dong, Indyk, Razenshteyn and Wagner, "Learning Space Partitions for
Nearest Neighbor Search" (2020): the neighbour graph of a bounded sample is cut
into balanced parts with few edges between them, and a small classifier learns
to tell the part of a vector.  Every row is indexed under its most probable
part; a query goes to its several most probable parts, and all rows found
there are ranked by exact cosine in double precision.  How many parts a query
visits is set on sample queries against brute force over the sample.

Parts are cut into blocks of at most ``BLOCK`` rows and the queries of a part
into blocks too, so a task never holds more than one block of each, also when
many rows are equal.  Each pair of blocks hands on the best ``k`` of each
query (all ties decided by the smaller id), and these are merged.

Vectors of different lengths have no cosine: each length is searched by itself,
the commonest and all with more than ``BLOCK`` rows through partitions of their
own, the rest exactly, one group a length.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part; components of any finite size are scored in full
precision (rows are scaled by a power of two first); candidates with the query's own id are its own row; repeated rows are
candidates once for each row; null ids take no part; a query that finds fewer
than k rows in its parts goes to all parts, so with fewer than k candidates all
are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, materialize

SAMPLE = 8192
BLOCK = 4096


def usable(docs: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): finite, non-zero vectors, as doubles."""
    ok = (F.col("vec_id").isNotNull() & F.col("v").isNotNull()
          & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists("v", lambda x: x != 0))
    return docs.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(ok)


def long_lengths(vectors: DataFrame) -> list[tuple[int, int]]:
    """(length, rows) of the commonest length and of all that more than
    ``BLOCK`` rows have: at most one for each ``BLOCK`` rows, and one."""
    sizes = vectors.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    first = sizes.orderBy(F.desc("rows"), "n").limit(1)
    got = first.union(sizes.where(F.col("rows") > BLOCK)).distinct().collect()
    return sorted((r["n"], r["rows"]) for r in got)


def _unit(x):
    import numpy as np

    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(x):
    """Rows times a power of two that brings their largest component near 1,
    so squares neither overflow nor vanish; a cosine keeps its bits."""
    import numpy as np

    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def neighbour_graph(u, k: int):
    """The k nearest rows of each row (itself left out), in blocks."""
    import numpy as np

    out = np.empty((len(u), k), np.int64)
    for a in range(0, len(u), 1024):
        s = u[a:a + 1024] @ u.T
        s[np.arange(len(s)), a + np.arange(len(s))] = -2
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        out[a:a + 1024] = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1), 1)
    return out


def balanced_parts(u, graph, parts: int, slack: float = 0.1, rounds: int = 12, seed: int = 7):
    """Parts of the graph with at most (1 + slack) times the mean size: seeded
    by nearest centres, then rows move to the part that most of their
    neighbours (both ways) are in while it has room."""
    import numpy as np

    n = len(u)
    rng = np.random.default_rng(seed)
    room = int(np.ceil((1 + slack) * n / parts))
    centres = u[rng.choice(n, parts, replace=False)]
    for _ in range(8):
        to = (u @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, to, u)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    choice = np.argsort(-(u @ centres.T), axis=1)
    part, size = np.full(n, -1), np.zeros(parts, np.int64)
    for i in rng.permutation(n):
        for p in choice[i]:
            if size[p] < room:
                part[i] = p
                size[p] += 1
                break
    both = [[] for _ in range(n)]
    for i, near in enumerate(graph.tolist()):
        for j in near:
            both[i].append(j)
            both[j].append(i)
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(part[both[i]], minlength=parts)
            here = part[i]
            votes_open = np.where((size < room) | (np.arange(parts) == here), votes, -1)
            best = int(votes_open.argmax())
            if best != here and votes_open[best] > votes[here]:
                size[here] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


@dataclass(frozen=True)
class Router:
    """One hidden layer: unit vector -> parts, most probable first."""
    w1: object
    b1: object
    w2: object
    b2: object

    def logits(self, u):
        import numpy as np

        return np.maximum(u @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, u, most: int):
        import numpy as np

        return np.argsort(-self.logits(u), axis=1, kind="stable")[:, :most]


def fit_router(u, target, hidden: int = 128, epochs: int = 40, batch: int = 256, rate: float = 3e-3,
               seed: int = 7) -> Router:
    """Soft targets (shares of a row's neighbours in each part), cross
    entropy, Adam."""
    import numpy as np

    rng = np.random.default_rng(seed)
    d, parts = u.shape[1], target.shape[1]
    p = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden),
         rng.normal(0, (1 / hidden) ** 0.5, (hidden, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(u))
        for a in range(0, len(u), batch):
            i = order[a:a + batch]
            x, y = u[i], target[i]
            h = np.maximum(x @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            g = (z / z.sum(1, keepdims=True) - y) / len(i)
            gh = (g @ p[2].T) * (h > 0)
            grads = [x.T @ gh + 1e-4 * p[0], gh.sum(0), h.T @ g + 1e-4 * p[2], g.sum(0)]
            t += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return Router(*p)


def fit(vectors: DataFrame, rows: int, k: int = 5, sample: int = SAMPLE, recall: float = 0.97,
        neighbours: int = 10) -> tuple[Router, int, int]:
    """(router, parts, parts that a query visits), from at most ``sample``
    vectors, those with the smallest hash of their components (equal vectors
    once)."""
    import numpy as np

    got = hash_sample(vectors.select("v", F.xxhash64("v").alias("h")).groupBy("h").agg(F.min("v").alias("v")),
                      "h", sample).collect()
    u = _unit(np.array([r["v"] for r in got], float).reshape(len(got), -1)) if got else np.zeros((0, 1))
    n = len(u)
    parts = int(min(max(8, rows // 2000), max(1, n // 32), 256))
    if parts < 2:
        d = u.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1, 1
    graph = neighbour_graph(u, min(neighbours, n - 1))
    part = balanced_parts(u, graph, parts)
    # Rows held out from the classifier set how many parts a query visits.
    held = np.arange(n) % 8 == 0
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(n), part] += 1
    target /= target.sum(1, keepdims=True)
    router = fit_router(u[~held], target[~held])
    home = router.ranked(u, 1)[:, 0]
    ranked = router.ranked(u[held], parts)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(parts)[None, :].repeat(len(ranked), 0), 1)
    wanted = np.take_along_axis(place, home[graph[held][:, :k]], 1).ravel()
    visits = int(np.quantile(wanted, recall, method="higher")) + 1
    return router, parts, visits


def _route(router, most: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        r = router.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            near = r.ranked(_unit(v), most).astype(np.int32)
            ends = np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.ListArray.from_arrays(pa.array(ends), pa.array(near.ravel()))],
                names=["vec_id", "v", "parts"])

    return run


def _search(k: int):
    def run(key, rows, queries):
        import numpy as np
        import pandas as pd

        cols = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(queries):
            v, q = _scaled(np.stack(rows["v"])), _scaled(np.stack(queries["v"]))
            vid, qid = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            nv = np.sqrt((v * v).sum(1))
            vu = _unit(v)
            for a in range(0, len(q), 512):
                rough = _unit(q[a:a + 512]) @ vu.T
                rough[qid[a:a + 512, None] == vid[None, :]] = -9
                kth = -np.partition(-rough, min(k, len(v)) - 1, axis=1)[:, min(k, len(v)) - 1]
                for i, line in enumerate(rough):
                    # All that may be among the best k, measured by one formula.
                    near = np.flatnonzero((line >= kth[i] - 1e-9) & (line > -8))
                    x = q[a + i]
                    s = (v[near] * x).sum(1) / (nv[near] * np.sqrt((x * x).sum()))
                    best = np.lexsort((vid[near], -s))[:k]
                    cols["query_id"] += [qid[a + i]] * len(best)
                    cols["vec_id"] += vid[near[best]].tolist()
                    cols["score"] += s[best].tolist()
        return pd.DataFrame(cols)

    return run


def search(table: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for
    each row that meets ``queries``, a condition on column ``vec_id``."""
    vectors = usable(table, id_col, vec_col)
    kind = table.schema[id_col].dataType.simpleString()
    long = long_lengths(vectors)
    found = [_search_length(vectors.where(F.size("v") == n), rows, queries, k, sample, kind) for n, rows in long]
    # Every other length has at most BLOCK rows.
    rest = vectors.where(~F.size("v").isin([n for n, _ in long])).withColumn("n", F.size("v"))
    hits = rest.groupBy("n").cogroup(rest.where(queries).distinct().groupBy("n")).applyInPandas(
        _search(k), f"query_id {kind}, vec_id {kind}, score double")
    return reduce(DataFrame.unionByName, found, _best(hits, k))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _search_length(vectors: DataFrame, rows: int, queries: Column, k: int, sample: int, kind: str) -> DataFrame:
    """Search among vectors of one length."""
    spark = vectors.sparkSession
    router, parts, visits = fit(vectors, rows, k, sample)
    if rows <= 2 * k:
        visits = parts
    held = spark.sparkContext.broadcast(router)  # a fixed number of weights
    schema = f"vec_id {kind}, v array<double>, parts array<int>"
    index = materialize(vectors.mapInArrow(_route(held, 1), schema)
                        .select("vec_id", "v", F.get("parts", F.lit(0)).alias("part")))
    queried = vectors.where(queries).distinct()
    asked = materialize(queried.mapInArrow(_route(held, visits), schema)
                        .select("vec_id", "v", F.explode("parts").alias("part")))

    def blocks(df, name):
        # One row for each part: at most 256 numbers.
        sizes = {r["part"]: -(-2 * r["count"] // BLOCK) for r in df.groupBy("part").count().collect()}
        table_ = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, max(1, sizes.get(p, 1)))])
        return F.element_at(table_, F.col("part")).alias(name)

    salt, keys = F.xxhash64("vec_id", "v"), ["part", "b", "c"]
    nb = blocks(index, "nb")

    def hits(asked):
        nq = blocks(asked, "nq")
        left = index.select("part", F.pmod(salt, nb).cast("int").alias("b"),
                            F.explode(F.sequence(F.lit(0), nq - 1)).alias("c"), "vec_id", "v")
        right = asked.select("part", F.explode(F.sequence(F.lit(0), nb - 1)).alias("b"),
                             F.pmod(salt, nq).cast("int").alias("c"), "vec_id", "v")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            _search(k), f"query_id {kind}, vec_id {kind}, score double")

    found = _best(hits(asked), k)
    if visits < parts:
        # Queries whose parts held too few rows go to all other parts too.
        found = materialize(found)
        full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
        short = materialize(queried.join(full, "vec_id", "left_anti").mapInArrow(_route(held, parts), schema)
                            .select("vec_id", "v", F.explode(F.slice("parts", visits + 1, parts)).alias("part")))
        if not short.isEmpty():
            found = _best(found.drop("rank").unionByName(hits(short)), k)
    return found
