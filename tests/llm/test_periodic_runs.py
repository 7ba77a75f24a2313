import hashlib
import random
import zlib

import numpy as np

from tessera.llm import periodic_runs as pr
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(w):
    """Every maximal stretch of every period, the smallest period kept."""
    out, n = [], len(w)
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    ids = np.array([number[x] for x in w])
    for q in range(1, n // 4 + 1):
        i = 0
        if n > 500:  # most periods have no three words in a row
            same = ids[q:] == ids[:-q]
            if not (same[2:] & same[1:-1] & same[:-2]).any():
                continue
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(
                    all(w[k] == w[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + k for s, k, q in runs)]
    best = min(((-k, s, q) for s, k, q in runs), default=None)
    found = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *found, hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def order(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r])


def test_random_sequences_against_brute_force():
    r = random.Random(3)
    docs = []
    for _ in range(1500):
        n = r.randint(0, 70)
        w = [r.randrange(r.choice([1, 2, 3, 6])) for _ in range(n)]
        if n and r.random() < 0.6:  # a repeat, sometimes inside another
            for _ in range(r.randint(1, 2)):
                a = r.randrange(n)
                p = 1 + (n - a) // r.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        docs.append(w)
    got = pr.runs_of(docs)
    assert sum(map(len, got.values())) > 500
    for i, w in enumerate(docs):
        assert got.get(i, []) == plain_runs(w)


def test_long_texts():
    assert pr.runs_of([[7] * 200_000])[0] == [(0, 200_000, 1)]
    w = list(range(30_000))
    assert pr.runs_of([w * 5]) == {0: [(0, 150_000, 30_000)]}
    assert pr.runs_of([w * 3]) == {}  # exponent three


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_periodic_runs"](spark, SF).select(*NAMES).collect()
    assert order(map(tuple, got)) == order(plain_row(*d) for d in docs)


def test_odd_documents(spark, odd_docs, no_docs):
    def result(df):
        return pr.digests(pr.find_runs(pr.repeat_tails(df))).select(*NAMES).collect()

    extra = spark.createDataFrame([(11, "a b " * 9), (11, "a b " * 9), (None, "x" + " x" * 9), (12, "  " * 8)],
                                  "doc_id long, text string")
    df = odd_docs.select("doc_id", "text", *[c for c in odd_docs.columns if c not in ("doc_id", "text")])
    assert order(map(tuple, result(df))) == order(plain_row(r["doc_id"], r["text"]) for r in df.collect())
    assert order(map(tuple, result(extra))) == order(plain_row(*r) for r in extra.collect())
    assert result(no_docs) == []
    clash = extra.selectExpr("doc_id", "text", "1 as _id", "2 as _t", "3 as runs", "4 as collapsed", "5 as _best")
    assert order(map(tuple, result(clash))) == order(plain_row(*r) for r in extra.collect())
