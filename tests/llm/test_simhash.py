import random

import xxhash

from tessera.llm import simhash


def plain_fingerprint(text, shingle=4):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    runs = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=4):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = least.setdefault(find(i), [])
        if d is not None:
            ids.append(d)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    out = sorted(((d, f"{fps[i]:016x}", min(least[find(i)], default=None)) for i, (d, _) in enumerate(rows)), key=key)
    return out, [min(ids, default=None) for ids in least.values()]


def near_copies(n=160):
    r = random.Random(4)
    base = [" ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(r.randint(0, 99))
                     for _ in range(120)) for _ in range(4)]
    out = []
    for i in range(n):
        words = base[i % 4].split()
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = "changed"
        out.append((1000 - i, " ".join(words)))
    return out


def same(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, simhash.components(df, **options).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == plain_components(rows)[0]


def test_components_against_brute_force(spark):
    rows = near_copies()
    assert 4 < len(plain_components(rows)[1]) < len(rows) - 40
    for blocks in (None, 8):
        same(spark, rows, blocks=blocks)


def test_hot_key_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    monkeypatch.setattr(simhash, "SMALL", 2)
    same(spark, near_copies(), blocks=5)


def test_edges(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    same(spark, rows)
    assert simhash.components(no_docs).count() == 0
    stay = simhash.deduplicate(odd_docs)
    assert stay.columns == odd_docs.columns
    groups = plain_components(rows)[1]
    got = [r.doc_id for r in stay.collect()]
    assert sorted(got, key=str) == sorted(groups, key=str)
    assert simhash.deduplicate(no_docs).count() == 0


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "u long, v long")
    got = {r.node: r.root for r in simhash.star_components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def test_copies_are_dropped_before_texts_are_shuffled(spark):
    docs = spark.createDataFrame([(1, "the very same row " * 9)] * 300 + [
        (i, f"{i} " + " ".join(str(i * k) for k in range(3, 30))) for i in range(2, 302)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stay = simhash.deduplicate(docs)
        ids = [r.doc_id for r in stay.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert ids.count(1) == 1 and len(ids) == len(set(ids))
    written = []

    def walk(plan):
        if plan.nodeName() == "Exchange" and "string" in plan.schema().simpleString():
            written.append(plan.metrics().apply("shuffleRecordsWritten").value())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(stay._jdf.queryExecution().executedPlan())
    assert written and max(written) <= 300 + 2 * docs.rdd.getNumPartitions(), written
