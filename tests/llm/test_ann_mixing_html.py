import hashlib
import html as H
import math
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import ann, mixing
from tessera.llm import html_extract as X
from tessera.llm.queries import QUERIES


def plain_nearest(rows, ask, k=5):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], float)
    out = {}
    for i, x in zip(ids, v):
        if ask(i):
            s = (v * x).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((x * x).sum()))
            best = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), s[j]) for j in best]
    return out


def test_recall_on_the_driver_table(spark):
    df = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    want = plain_nearest(rows, lambda i: i % 50 == 0)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hit = sum(len({a for a, _ in want[q]} & {a for a, _ in got[q].values()}) for q in want)
    assert hit >= 0.9 * 5 * len(want), hit / 5 / len(want)


def test_equal_vectors_in_blocks_and_edges(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    r = np.random.default_rng(3)
    hot = r.normal(size=8)
    rows = [(i, hot.tolist() if i % 3 == 0 else r.normal(size=8).tolist()) for i in range(600)]
    bad = [(1000, None), (1050, [0.0] * 8), (1100, [None] + [1.0] * 7), (1150, [float("nan")] + [1.0] * 7),
           (1200, [float("inf")] * 8), (1250, [1.0]), (None, [1.0] * 8)]
    schema = "vec_id long, embedding array<float>, part int, v int"
    df = spark.createDataFrame([(i, x, 0, 0) for i, x in rows + bad], schema)
    exact = [(i, np.array(x, np.float32)) for i, x in rows]
    want = plain_nearest(exact, lambda i: i % 50 == 0)
    got = {}
    for x in ann.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    assert got.keys() == want.keys()
    for q in want:
        if q % 3 == 0:  # ties go to the smaller id
            assert [v for _, v, _ in sorted(got[q])] == [v for v, _ in want[q]]
    few = spark.createDataFrame([(0, [1.0, 0.0], 0, 0), (1, [0.0, 1.0], 0, 0), (2, [1.0, 1.0], 0, 0)], schema)
    assert [(x["rank"], x.vec_id) for x in ann.search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 2), (2, 1)]
    assert ann.search(few.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.search(few.limit(1), F.col("vec_id") == 0).count() == 0


def test_sample_and_recall_where_most_rows_are_copies(spark, monkeypatch):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=16).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(1200 + i, rows[0][1]) for i in range(58_800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").cache()
    seen = []
    monkeypatch.setattr(ann, "_unit", lambda x, f=ann._unit: seen.append(len(x)) or f(x))
    router, parts, visits = ann.fit(ann.usable(df, "vec_id", "embedding"), len(rows), sample=600)
    assert seen == [600] and parts == 600 // 32
    monkeypatch.undo()
    ask = (F.col("vec_id") > 0) & (F.col("vec_id") < 1200) & (F.col("vec_id") % 20 == 0)
    want = plain_nearest(rows, lambda i: 0 < i < 1200 and i % 20 == 0)
    got = {}
    for x in ann.search(df, ask, sample=600).collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    assert got.keys() == want.keys()
    hit = sum(len({a for a, _ in want[q]} & got[q]) for q in want)
    assert hit >= 0.9 * 5 * len(want), hit / 5 / len(want)


def test_queries_whose_parts_hold_too_few_rows(spark, monkeypatch):
    r = np.random.default_rng(9)
    x = r.normal(size=(200, 6)).astype(np.float32)
    x[:, 0] = np.abs(x[:, 0]) * np.where(np.arange(200) < 3, 1, -1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    # The sign of the first number routes: three rows in part 0, none in part 2.
    w1, w2 = np.zeros((6, 2)), np.zeros((2, 3))
    w1[0], w2[:2, :2], w2[:, 2] = (1, -1), np.eye(2), -1
    held = ann.Router(w1, np.zeros(2), w2, np.zeros(3))
    monkeypatch.setattr(ann, "fit", lambda *a, **b: (held, 3, 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ask = (F.col("vec_id") < 3) | (F.col("vec_id") % 50 == 0)
    want = plain_nearest(rows, lambda i: i < 3 or i % 50 == 0)
    got = {}
    for y in ann.search(df, ask).collect():
        got.setdefault(y.query_id, []).append((y["rank"], y.vec_id))
    assert got.keys() == want.keys() and all(sorted(a for a, _ in g) == [1, 2, 3, 4, 5] for g in got.values())
    for q in range(3):
        assert [v for _, v in sorted(got[q])] == [v for v, _ in want[q]]


def test_components_of_any_finite_size(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(300, 6))
    scale = [1e200, 1e-200, 1.0, 1e-300, 1e300]
    rows = [(i, (v * scale[i % 5]).tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = ann.search(df, F.col("vec_id") % 50 == 0).collect()
    assert len(got) == 6 * 5 and all(abs(g.score - float(u[g.query_id] @ u[g.vec_id])) < 1e-12 for g in got)
    two = spark.createDataFrame([(0, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [5e-324, 5e-324])], df.schema)
    assert [(g.vec_id, round(g.score, 6)) for g in ann.search(two, F.col("vec_id") == 0).orderBy("rank").collect()] == [
        (2, 1.0), (1, 0.707107)]


def test_each_length_is_searched(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    r = np.random.default_rng(6)
    sizes = {8: 500, 5: 200, 3: 60, 2: 2, 1: 1}  # the first two have more than a block
    rows, i = [], 0
    for d, n in sizes.items():
        for _ in range(n):
            rows.append((i, r.normal(size=d).tolist()))
            i += 1
    rows += [(i, rows[-1][1]), (i + 1, None), (i + 2, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert ann.long_lengths(ann.usable(df, "vec_id", "embedding")) == [(5, 200), (8, 500)]
    want = {}
    for d in sizes:
        want |= plain_nearest([x for x in rows if x[1] and len(x[1]) == d], lambda j: j % 20 == 0 or j > 755)
    got = {}
    for x in ann.search(df, (F.col("vec_id") % 20 == 0) | (F.col("vec_id") > 755)).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id))
    assert got.keys() == {q for q in want if want[q]}
    for q, near in want.items():
        if near:
            assert len(got[q]) == len(near)
            if q >= 700:  # exact among the short ones
                assert [v for _, v in sorted(got[q])] == [v for v, _ in near]
    hit = sum(len({a for a, _ in want[q]} & {a for _, a in got[q]}) for q in got)
    assert hit >= 0.9 * sum(len(want[q]) for q in got)


def test_parts_are_balanced():
    u = ann._unit(np.random.default_rng(1).normal(size=(600, 12)))
    part = ann.balanced_parts(u, ann.neighbour_graph(u, 8), 8)
    assert np.bincount(part, minlength=8).max() <= math.ceil(1.1 * 600 / 8) and part.min() >= 0


def test_poisson_thresholds():
    for rate in (0.0, 1e-9, 0.3, 1.0, 7.5, 900.0):
        t = mixing.thresholds(rate)
        assert t == sorted(t) and (not t or t[-1] > 1 - 1e-9)
        if 0 < rate < 20:
            mean = sum(1 - c for c in t)
            assert abs(mean - rate) < 1e-6


def test_mix_against_plain(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 5), f"s{i % 3}") for i in range(900)]
                                 + [(5, "twice", "s0"), (5, "twice", "s0"), (None, "x", None)],
                                 "doc_id long, text string, source string")
    weights = {"s0": 3.0, "s1": 1.0, "*": 1.0}
    rates = mixing.repetition_rates(docs, weights)
    want = Counter()
    for r in docs.collect():
        name = "" if r.doc_id is None else str(r.doc_id)
        u = int(hashlib.md5(f"mix:{name}".encode()).hexdigest()[:13], 16) / 2 ** 52
        rate = rates[r.source if r.source in weights else "*"]
        k, p, cum = 0, math.exp(-rate), math.exp(-rate)
        while u >= cum:
            want[r.doc_id, r.text, k] += 1
            k += 1
            p *= rate / k
            cum += p
    got = mixing.mix(docs, weights)
    assert Counter((r.doc_id, r.text, r["copy"]) for r in got.collect()) == want
    size = {r.source: r.n for r in got.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert abs(size["s0"] / sum(size.values()) - 0.6) < 0.06
    keys = [r.shuffle_key for r in got.collect()]
    assert keys == sorted(keys)
    assert mixing.mix(odd_docs, {"src1": 1.0}).count() > 0
    assert mixing.mix(odd_docs, {"nowhere": 1.0}).count() == 0
    assert mixing.mix(no_docs, weights).count() == 0


def test_mix_query_returns_whole_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = QUERIES["op9_mixing_documents"](spark, SF_SMALL)
    assert got.columns == [*docs.columns, "copy", "shuffle_key"]
    rows, whole = got.collect(), {r.doc_id: tuple(r) for r in docs.collect()}
    assert all(tuple(r)[:len(docs.columns)] == whole[r.doc_id] for r in rows)
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)
    ids = ("doc_id", "source", "copy", "shuffle_key")
    assert Counter(tuple(r[c] for c in ids) for r in rows) == Counter(
        tuple(r[c] for c in ids) for r in QUERIES["op9_mixing"](spark, SF_SMALL).collect())


@pytest.fixture(scope="module")
def model():
    return X.fit_pages(X.templates())


def read(html, model, plain=False):
    page = X.Page(html)
    return X.text_of(page, X.decode(page, model.margin(X.features(page, plain))))


def test_pages_of_the_driver_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in X.extract(df, X.fit(df)).collect()}
    for r in df.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(H.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_other_layouts(model):
    fresh = X.templates(160)[120:]
    for html in fresh:
        page = X.Page(html)
        want = X.text_of(page, [bool(x) for x in X.named_labels(page)])
        assert read(html, model) == want


def test_decoding_is_the_best_consistent_labelling():
    from itertools import product
    rng = np.random.default_rng(2)
    for _ in range(60):
        page = X.Page("<div><p><b>a</b>b</p><ul><li>c</li></ul></div><p>d</p>")
        n = len(page.tags)
        m = rng.normal(size=n)
        best = 0.0
        for labels in product((0, 1), repeat=n):
            state, ok = [], True
            for i, p in enumerate(page.parents):
                up = state[p] if p >= 0 else 0
                ok &= not (labels[i] and up == 2)
                state.append(1 if labels[i] else (2 if up else 0))
            if ok:
                best = max(best, float(np.dot(labels, m)))
        got = X.decode(page, m)
        assert abs(float(np.dot(got, m)) - best) < 1e-9


def test_odd_html(spark, model):
    odd = [None, "", "plain text &amp; more", "<", "<article><p>one<p>two &lt;b&gt; <br>three", "</p></div><p>x", "<div>" * 5000 + "deep",
           "<!-- never closed <p>x</p>", "<script>var a='<p>no</p>'", "<article>" + "<p>word word word.</p>" * 3000 + "</article>"]
    df = spark.createDataFrame([(i, None, h, 0) for i, h in enumerate(odd)] * 2, "page_id long, url string, html string, text int")
    got = X.extract(df, model).collect()
    assert len(got) == 2 * len(odd)
    by = {r.page_id: r.text for r in got}
    assert by[0] == by[1] == "" and by[4] == "one\ntwo <b> three"
    assert "no" not in by[8] and by[9].count("\n") == 2999
    assert X.extract(df.limit(0), model).count() == 0


def test_stray_quotes_in_tags(spark, model):
    html = ["<article><p>one <a href=/o'neil>link</a> two</p><p>three</p><p>don't stop</p></article>",
            '<article><p>one <a href=/oneil">link</a> two</p><p>three</p></article>',
            '<article><p>one <a href=/?q="five>link</a> two</p><p>say "three"</p></article>',
            '<article><p>one <a title = "a > b" href=\'/x?y>z\' c>link</a> two</p></article>',
            '<article><p>one <a b=" c>link</a> two</p></article>']
    want = ["one link two\nthree\ndon't stop", "one link two\nthree", 'one link two\nsay "three"', "one link two", "one link two"]
    pages = [X.Page(h) for h in html]
    assert [X.text_of(p, [True] * len(p.tags)) for p in pages] == want
    assert all(p.tags.count("a") == 1 for p in pages)
    df = spark.createDataFrame([(0, None, html[0], 0), (1, None, html[1], 0)], "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in X.extract(df, model).collect()}
    assert got[0].endswith(" two\nthree\ndon't stop") and got[1].endswith(" two\nthree") and "<" not in got[1]
    assert X.Page("<a" + ' x="1" y=\'2\'' * 20000).tags == ["#page"]


def whole(html):
    page = X.Page(html)
    return X.text_of(page, [True] * len(page.tags))


def test_references_lie_within_text_nodes():
    assert whole("<p>&<b>amp;</b> &amp;lt; &am<!-- -->p;</p>") == "&amp; &lt; &amp;"
    assert whole("<p>&#65;&#x42;&#" + "0" * 5000 + "67;&#" + "9" * 5000 + ";&eacute;</p>") == "ABC\ufffd\u00e9"


def test_tags_read_in_parts(monkeypatch):
    long = '<p title="' + "x > y " * 300 + "\" class='main text' data-x=" + "z" * 2000 + ">one</p><p <b>two <a x=\"</p><p>three"
    want = X.Page(long)
    assert want.tags == ["#page", "p", "p", "a", "p"] and want.words[1] == {"main", "text"}
    monkeypatch.setattr(X, "SHORT", 3)
    got = X.Page(long)
    assert (got.tags, got.parents, got.words, got.items) == (want.tags, want.parents, want.words, want.items)


@pytest.mark.parametrize("unit,tail", [("<a ", ""), ("<a", ">"), ("</x", ""), ('<a href="', ""), ('<a x=">" ', ""),
                                       ('<a x=">"', "'"), ("<!", ""), ("</script ", ""), ("<a   ", '"')])
def test_a_megabyte_of_tags_that_never_end(unit, tail):
    start = time.process_time()
    X.Page("<script>" * (unit == "</script ") + unit * (1_000_000 // len(unit)) + tail)
    assert time.process_time() - start < 10


def test_a_megabyte_of_nested_items():
    for html in ("<div>" * 100_000 + "<li>x" * 100_000, "<table>" + "<span>" * 100_000 + "<tr>" * 80_000,
                 "<dl>" + "<dt><b>" * 100_000 + "<dd>" * 60_000):
        start = time.process_time()
        X.Page(html)
        assert time.process_time() - start < 10
    assert X.Page("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>").parents == [-1, 0, 1, 2, 3, 3, 1]
    assert X.Page("<table><tr><td>a<td>b<tr><th>c</table>").parents == [-1, 0, 1, 2, 2, 1, 5]
