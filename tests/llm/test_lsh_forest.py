import random

from pyspark.sql import functions as F

from tessera.llm import lsh_forest
from tessera.llm.common import materialize
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_set(text, shingle=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1)))


def plain_components(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    distinct = list({s for s in sets if s})
    comp = {s: s for s in distinct}

    def find(s):
        while comp[s] is not s:
            s = comp[s]
        return s

    holders = {}
    for s in distinct:
        for x in s:
            holders.setdefault(x, []).append(s)
    for s in distinct:
        for o in {id(o): o for x in s for o in holders[x]}.values():
            both = len(s & o)
            if 100 * both >= percent * (len(s) + len(o) - both):
                comp[find(s)] = find(o)
    least = {}
    for (d, _), s in zip(rows, sets):
        if s:
            ids = least.setdefault(find(s), [])
            if d is not None:
                ids.append(d)
    out = []
    for (d, _), s in zip(rows, sets):
        c = min(least[find(s)], default=None) if s else d
        out.append((d, len(s), c, None if d is None else d == c))
    return out


def order(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) for x in r])


def same(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lsh_forest.components(df, **options).collect()
    assert order(map(tuple, got)) == order(plain_components(rows))
    return got


def near_copies(n, bases=5, words=150, edits=4, seed=4):
    """Copies with a few words changed, so many pairs lie about the threshold."""
    r = random.Random(seed)
    base = [[f"w{r.randint(0, 5000)}" for _ in range(words)] for _ in range(bases)]
    out = []
    for i in range(n):
        w = list(base[i % bases])
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"changed{r.randint(0, 99)}"
        out.append((n - i, " ".join(w)))
    return out


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_minhash_near_dedup"](spark, SF).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert order(map(tuple, got)) == order(plain_components([tuple(d) for d in docs]))


def test_near_copies_against_brute_force(spark):
    got = same(spark, near_copies(200))
    assert 5 <= len({r["component_id"] for r in got}) < 200


def test_crowded_regions_and_many_chunks(spark):
    """Regions deepened to the last level, then hubs and probes over chunks."""
    rows = near_copies(240, bases=2, edits=9, seed=9)
    got = same(spark, rows, region=8, chunk_nodes=16, hubs=4)
    assert len({r["component_id"] for r in got}) > 2
    same(spark, rows, region=8, chunk_nodes=16, hubs=0)
    same(spark, rows, depths=(4,), region=2, chunk_shingles=300)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = lsh_forest.components(odd_docs).collect()
    assert order(map(tuple, got)) == order(plain_components(rows))
    assert lsh_forest.components(no_docs).collect() == []
    twice = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (2, "A B c d e f"), (None, "only null ids here now"),
             (None, "only null ids here now"), (5, "a b"), (6, "a  B"), (7, "a b c d e"), (8, " ")]
    df = spark.createDataFrame(twice, "doc_id long, text string")
    for name in ("_id", "_t", "_w", "_m", "n", "s1", "s2", "node", "root", "lead", "labels", "sketch", "least"):
        df = df.withColumn(name, F.lit(1))
    assert order(map(tuple, lsh_forest.components(df).collect())) == order(plain_components(twice))


def test_exact_threshold(spark):
    """Links at exactly 85 in 100 count, one shingle less does not."""
    w = [f"a{i}" for i in range(204)]  # 200 shingles
    at = w[:174] + [f"b{i}" for i in range(0)]  # 170 of them
    below = [x + "q" for x in w]
    same(spark, [(1, " ".join(w)), (2, " ".join(at)), (3, " ".join(below)), (4, " ".join(below[:173]))])


def test_links_are_few(spark):
    """A group of copies hands on links that grow with its nodes, not pairs."""
    nodes = []
    docs = spark.createDataFrame(near_copies(300, bases=1), "doc_id long, text string")
    src = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_t"))
    nodes = materialize(src.mapInArrow(lsh_forest._sketches(5), "_id long, n long, s1 long, s2 long, labels binary, sketch binary")
                        .dropDuplicates(["s1", "s2"]).withColumn("node", F.monotonically_increasing_id()))
    n = nodes.count()
    assert lsh_forest.candidate_links(nodes, region=64).count() < 40 * n
