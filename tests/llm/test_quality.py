import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import gbt
from tessera.llm import quality_classifier as QC
from tessera.llm import quality_rules as Q


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, at = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for starts in seen.values():
        if len(starts) > 1:
            at.update(j for i in starts for j in range(i, i + 8))
    n = len(words)
    failed = n < 20 or 100 * len(at) > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(at), failed)


def texts():
    r = random.Random(6)
    bits = ["a", "b", "a b c d e f g h ", "\n", " ", "\t", " ", "é#", "|", "x y z\n", "repeat this line of some words here now\n", "中"]
    return ["".join(r.choice(bits) + " " * r.randint(0, 1) for _ in range(r.randint(0, 60))) for _ in range(300)]


def test_statistics_against_plain(spark, odd_docs, no_docs):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    got = Q.judge(df, []).collect()
    want = sorted((str(d), *plain_statistics(t)) for d, t in map(tuple, df.collect()))
    assert sorted((str(r.doc_id), *[r[c] for c in Q.BASE], r.base_failed) for r in got) == want
    assert all(r.kept == (not r.base_failed) for r in got)
    assert any(w[5] for w in want) and any(w[4] for w in want)
    assert Q.judge(no_docs, []).count() == 0
    assert Q.keep(odd_docs, []).columns == odd_docs.columns


def test_covering_finds_the_rules():
    r = random.Random(1)
    rows = [{"a": r.random(), "b": r.random(), "c": r.random()} for _ in range(3000)]
    bad = [(x["a"] > 0.8 and x["b"] <= 0.5) or x["c"] > 0.95 for x in rows]
    rules = Q.learn(rows, bad)

    def met(x):
        return any(all((x[c.measure] > c.bound) == c.above for c in rule) for rule in rules)

    fresh = [{"a": r.random(), "b": r.random(), "c": r.random()} for _ in range(3000)]
    truth = [(x["a"] > 0.8 and x["b"] <= 0.5) or x["c"] > 0.95 for x in fresh]
    assert sum(met(x) == t for x, t in zip(fresh, truth)) > 2880
    assert Q.learn([], []) == [] and Q.learn(rows[:50], [False] * 50) == []
    assert Q.learn(rows[:60], [True] * 60) == []


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda n: spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/{n}.parquet")
    return read("documents"), read("labels")


def test_rules_on_the_driver_table(spark, tables, no_docs):
    docs, labels = tables
    rules = Q.fit(docs, labels)
    got = Q.judge(docs, rules).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.03 * n[1, True]
    assert n.get((0, False), 0) >= 0.6 * (n.get((0, False), 0) + n.get((0, True), 0))
    assert Q.fit(no_docs, labels) == [] and Q.fit(docs, labels.limit(0)) == []
    plan = Q.judge(docs, rules)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    kept = {r.doc_id for r in Q.judge(docs, rules).where("kept").select("doc_id").collect()}
    rows = Q.keep(docs, rules)
    assert {r.doc_id for r in rows.select("doc_id").collect()} == kept
    assert len(rows._jdf.queryExecution().optimizedPlan().toString()) < 40_000


def test_trees_flattened_traversal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    t = gbt.fit(x[:3000], y[:3000], trees=30)

    def walk(row):
        out = t.base
        for f, b, leaf in zip(t.feature, t.bound, t.leaf):
            i = 0
            while i < len(f):
                i = 2 * i + (2 if row[f[i]] > b[i] else 1)
            out += leaf[i - len(f)]
        return out

    assert np.allclose([walk(r) for r in x[:100]], t.margin(x[:100]))
    assert ((t.score(x[3000:]) > 0.5) == (y[3000:] > 0)).mean() > 0.95
    assert np.allclose(gbt.fit(x[:0], y[:0]).score(x[:3]), 0.5)
    assert gbt.fit(x[:10], np.ones(10)).score(x[:1])[0] > 0.9


def test_classifier_held_out(spark, tables, odd_docs, no_docs):
    docs, labels = tables
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = QC.fit(docs, labels, ~held)
    got = QC.score(docs, model).join(labels.where(held), "doc_id").select("score", "quality").collect()
    s, y = np.array([r.score for r in got]), np.array([r.quality for r in got])
    pairs = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert pairs > 0.95, pairs
    assert QC.score(odd_docs, model).count() == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in QC.score(odd_docs, model).collect())
    empty = QC.fit(no_docs, labels)
    assert {r.score for r in QC.score(odd_docs, empty).collect()} == {0.5}
    assert QC.score(no_docs, model).count() == 0
