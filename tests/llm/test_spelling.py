import random
import re
import zlib
from collections import Counter

from tessera.llm import spelling
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def plain_variants(n, ratio=5):
    """Neighbours by leaving out or blanking one letter."""
    holders = {}
    for w in n:
        for i in range(len(w)):
            holders.setdefault(("blank", w[:i], w[i + 1:]), set()).add(w)
            holders.setdefault(("text", w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in n}
    for (kind, *rest), ws in holders.items():
        if kind == "blank":
            for w in ws:
                near[w] |= ws - {w}
        elif rest[0] in n:
            for w in ws - {rest[0]}:
                near[w].add(rest[0])
                near[rest[0]].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def variants(spark, n):
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    return sorted(map(tuple, spelling.group_variants(df).select(*COLS).collect()))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op12_spelling_variants"](spark, SF).select(*COLS).collect()))
    assert got == plain_variants(plain_words([tuple(d) for d in docs])) and got


def test_dense_words_against_brute_force(spark):
    """All edits at all places, repeated letters and chains of forms."""
    r = random.Random(6)
    n = {}
    for _ in range(900):
        n["".join(r.choice("abéÿ") for _ in range(r.randint(6, 9)))] = 5 ** r.randint(1, 6)
    for k in range(6, 13):
        n["a" * k] = 5 ** (k - 4)
    got = variants(spark, n)
    assert got == plain_variants(n)
    assert any(form is not None and root != form for _, form, root, *_ in got)


def test_one_edit(spark):
    pairs = [("abc", "abd", True), ("abc", "ab", True), ("abc", "bc", True), ("abc", "xabc", True), ("abc", "acb", False),
             ("abc", "abc", False), ("aab", "ab", True), ("éa", "ÿa", True), ("abcd", "abxy", False), ("ab", "abcd", False)]
    df = spark.createDataFrame(pairs, "x string, y string, w boolean")
    assert df.where(spelling._one_edit("x", "y") != df["w"]).collect() == []


def test_long_words(spark):
    long = "xy" * 20_000
    n = {"q" + long: 500, "z" + long: 7, "zebras": 5, "zebra÷s": 30, "zebrasq": 5}
    got = variants(spark, n)
    assert [r[1] for r in got if r[0] == "z" + long] == ["q" + long]


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(1, "Spelling spelling SPELLING, spelling; spelling speling spellin"), (2, None), (3, ""), (4, " \n "),
            (None, "Spelling spelling Étoile étoile"), (5, "speling speling speling speling " * 3),
            (5, "speling speling speling speling " * 3), (6, "spelling " * 200), (7, "x" * 70_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("_id", "_t", "word", "n", "w", "node", "kids", "root"):
        df = df.selectExpr("*", f"1 as {name}")
    got = sorted(map(tuple, spelling.group_variants(spelling.count_words(df)).select(*COLS).collect()))
    assert got == plain_variants(plain_words(rows)) and len(got) > 1
    every = spelling.group_variants(spelling.count_words(odd_docs, least_count=1)).collect()
    assert every and all(len(r["word"]) >= 6 for r in every)
    assert spelling.group_variants(spelling.count_words(no_docs)).collect() == []
