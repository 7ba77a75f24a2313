from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import text as T
from tessera.operators import graph as G
from tessera.operators import text as X


def test_concordance_positions(spark):
    # Literal sentences from the reference's concordance spec.
    df = spark.createDataFrame([(1, "Hello World!"), (2, "Hello\nWorld!")], "doc_id int, text string")
    got = rows(X.concordance(df), "doc_id", "line", "col", "word")
    assert got == [(1, 1, 1, "hello"), (1, 1, 7, "world"), (2, 1, 1, "hello"), (2, 2, 1, "world")]


def test_concordance_all_or_nothing_lines_and_pages(spark):
    df = spark.createDataFrame([(1, "good line here\nbad (line)\n  indented  words  /pnext page")],
                               "doc_id int, text string")
    got = rows(X.concordance(df), "page", "line", "col", "word")
    assert (1, 2, 1, "bad") not in got
    assert (1, 3, 3, "indented") in got and (1, 3, 13, "words") in got and (2, 1, 1, "next") in got


def test_concordance_unicode_mode_keeps_accents(spark):
    df = spark.createDataFrame([(1, "Noémie a dit")], "doc_id int, text string")
    assert X.concordance(df).count() == 0
    assert rows(X.concordance(df, mode="unicode"), "col", "word") == [(1, "noémie"), (8, "a"), (10, "dit")]


def test_range_strip_keeps_dash(spark):
    df = spark.createDataFrame([(1, "well- done.")], "doc_id int, text string")
    assert rows(X.concordance(df, strip=X.STRIP_RANGE), "word") == [("done",), ("well-",)]


def _only_rows(df):
    """The optimized plan's branch for keys that come once."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    k = next(i for i, x in enumerate(plan) if "Union" in x)
    at = plan[k + 1].index(":- ")
    return "\n".join(plan[k + 1:next(i for i in range(k + 2, len(plan)) if plan[i][at:at + 2] == "+-")])


_REPEATED = [(1, "a b /pa\nb, a c"), (2, "x y"), (2, "x y"), (None, "n m"), (3, None), (3, "z"), (4, "(no) words ("),
             (5, ""), (6, None), (None, None)]


def test_concordance_keeps_words_out_of_windows_and_sorts(spark):
    df = spark.createDataFrame(_REPEATED, "doc_id int, text string")
    for got in (X.concordance(df), X.concordance(df, mode="unicode"), X.concordance(df, strip=X.STRIP_RANGE),
                X.concordance_nested(X.concordance(df, per_doc=True))):
        branch = _only_rows(got)
        assert branch.count("Window ") == 1 and "count(1)" in branch and "Aggregate" not in branch


def test_concordance_of_repeated_and_null_documents(spark):
    df = spark.createDataFrame(_REPEATED, "doc_id int, text string")
    # Rows of one document share its lines: both x come before both y.
    want = [(1, 1, 1, 1, "a"), (1, 1, 1, 3, "b"), (1, 2, 1, 1, "a"), (1, 2, 2, 1, "b"), (1, 2, 2, 4, "a"), (1, 2, 2, 6, "c"),
            (2, 1, 1, 1, "x"), (2, 1, 1, 2, "x"), (2, 1, 1, 4, "y"), (2, 1, 1, 6, "y"), (3, 1, 1, 1, "z"),
            (None, 1, 1, 1, "n"), (None, 1, 1, 3, "m")]
    assert rows(X.concordance(df)) == want
    for index in (X.concordance(df), X.concordance(df, per_doc=True)):
        nested = {r.doc_id: [tuple(e) for e in r.entries] for r in X.concordance_nested(index).collect()}
        assert nested == {d: [w[1:] for w in want if w[0] == d] for d in (1, 2, 3, None)}


def test_concordance_of_a_long_line(spark):
    words = ["w" * (i * 7 % 5 + 1) for i in range(3000)]
    blanks = [" " * (i * 3 % 4 + 1) for i in range(3000)]
    df = spark.createDataFrame([(1, "".join(b + w for b, w in zip(blanks, words)) + "  ")], "doc_id int, text string")
    at, want = 0, []
    for b, w in zip(blanks, words):
        want.append((at + len(b) + 1, w))
        at += len(b) + len(w)
    assert rows(X.concordance(df), "col", "word") == want
    assert [(e.col, e.word) for e in X.concordance_nested(X.concordance(df, per_doc=True)).first().entries] == want


def test_offsets_within_an_array(spark):
    for n in (0, 1, 2, 3, 4, 5, 16, 17, 1000):
        parts = ["é" * (i % 3) for i in range(n)]
        df = spark.createDataFrame([(parts,)], "p array<string>")
        assert df.select(T.offsets("p")).first()[0] == [sum(map(len, parts[:i])) for i in range(n)]


def test_word_value_counts_within_rows_and_over_repeated_keys(spark):
    df = spark.createDataFrame([*_REPEATED, (7, "b a  b\tC b")], "doc_id int, text string")
    got = X.word_value_counts(df, "doc_id", "text")
    assert "Aggregate" not in _only_rows(got)
    assert {r.doc_id: r.counts for r in got.collect()} == {
        1: {"a": 2, "b": 1, "/pa": 1, "b,": 1, "c": 1}, 2: {"x": 2, "y": 2}, 3: {"z": 1}, 4: {"(": 1, "(no)": 1, "words": 1},
        7: {"C": 1, "a": 1, "b": 3}, None: {"m": 1, "n": 1}}
    assert got.where("doc_id = 7").select(F.to_json("counts")).first()[0] == '{"C":1,"a":1,"b":3}'


def test_url_resolution_and_filters(spark):
    df = spark.createDataFrame([
        ("http://a.com/x/y.html?q=1", "/root"), ("http://a.com/x/y.html", "z.htm"), ("https://a.com/x", "//b.org/p"),
        ("http://a.com/", "ftp://f.org/a"), ("http://a.com/x", "#top"), ("http://a.com/x", "pic.png")],
        "base string, href string")
    got = df.select(G.resolve_url("base", "href").alias("u")).withColumn("ok", G.valid_protocol("u") & G.can_parse("u"))
    got = [(r.u, r.ok) for r in got.collect()]
    assert got == [("http://a.com/root", True), ("http://a.com/x/z.htm", True), ("https://b.org/p", True),
                   ("ftp://f.org/a", False), ("http://a.com/x#top", True), ("http://a.com/pic.png", False)]


def test_crawl_depths(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert rows(G.crawl(links, seeds, 2), "url", "depth") == [("a", 0), ("b", 1), ("c", 2)]
    assert dict(rows(G.crawl(links, seeds, 10), "url", "depth"))["e"] == 4


def test_tree_nested_sets(spark):
    nodes = spark.createDataFrame([("A", None, 0), ("B", "A", 1), ("C", "A", 2), ("D", "C", 1)],
                                  "id string, parent string, key bigint")
    sized = G.tree_sizes(nodes)
    ns = dict((r.id, (r.lft, r.rgt, r.size, r.depth)) for r in G.nested_sets(sized).collect())
    assert ns == {"A": (1, 8, 4, 0), "B": (2, 3, 1, 1), "C": (4, 7, 2, 1), "D": (5, 6, 1, 2)}


def test_forest_with_cycles_and_missing_parents(spark):
    nodes = spark.createDataFrame([("A", None, 2), ("B", None, 1), ("C", "A", 1), ("D", "A", 1), ("E", "D", 0),
                                   ("X", "Y", 1), ("Y", "X", 1), ("Z", "Y", 1), ("L", "gone", 1), ("M", "L", 1)],
                                  "id string, parent string, key bigint")
    ns = {r.id: (r.lft, r.rgt, r.size, r.depth) for r in G.nested_sets(G.tree_sizes(nodes)).collect()}
    assert ns == {"B": (1, 2, 1, 0), "A": (3, 10, 4, 0), "C": (4, 5, 1, 1), "D": (6, 9, 2, 1), "E": (7, 8, 1, 2)}


def test_random_tree_matches_paths(spark):
    import random

    r = random.Random(8)
    parent = {i: r.randrange(max(0, i - 60), i) if i else None for i in range(300)}
    nodes = spark.createDataFrame([(i, p, r.randint(0, 3) * 1000 + i) for i, p in parent.items()],
                                  "id bigint, parent bigint, key bigint")
    pre = {x.id: i for i, x in enumerate(G.tree_paths(nodes).orderBy("path").collect())}
    size = dict.fromkeys(parent, 0)
    for i in parent:
        while i is not None:
            size[i] += 1
            i = parent[i]
    for x in G.nested_sets(G.tree_sizes(nodes)).collect():
        assert (x.lft, x.rgt) == (2 * pre[x.id] - x.depth + 1, 2 * pre[x.id] - x.depth + 2 * size[x.id])


def test_deep_path_and_wide_star(spark):
    """Rounds grow with the logarithm of the depth; a parent may hold all nodes."""
    n = 100_000
    path = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(0).cast("bigint").alias("key"))
    got = G.nested_sets(G.tree_sizes(path))
    assert got.where(f"depth <> id or size <> {n} - id or lft <> id + 1 or rgt <> {2 * n} - id").isEmpty()
    assert got.count() == n
    m = 1_000_000
    star = spark.range(m).select("id", F.when(F.col("id") > 0, F.lit(0)).cast("bigint").alias("parent"), F.col("id").alias("key"))
    got = G.nested_sets(G.tree_sizes(star))
    assert got.where("id > 0 and (depth <> 1 or size <> 1 or lft <> 2 * id or rgt <> 2 * id + 1)").isEmpty()
    assert got.where("id = 0").first()[1:] == (0, m, 1, 2 * m) and got.count() == m


def test_triplets_default_vertex(spark):
    # Vertex/edge shapes of the reference's property-graph sample.
    v = spark.createDataFrame([(3, "rxin", "student"), (7, "jgonzal", "postdoc"), (5, "franklin", "prof"),
                               (2, "istoica", "prof")], "id long, name string, role string")
    e = spark.createDataFrame([(3, 7, "collab"), (5, 3, "advisor"), (2, 5, "colleague"), (5, 7, "pi"), (5, 0, "x")],
                              "src long, dst long, attr string")
    d = {"name": "John Doe", "role": "Missing"}
    assert G.graph_vertices(v, e, d).count() == 5
    t = dict(((r.src, r.dst), r.dst_name) for r in G.triplets(v, e, ["name", "role"], d).collect())
    assert t[(5, 0)] == "John Doe" and t[(3, 7)] == "jgonzal"


def test_references_of_rfc_3986(spark):
    """The examples of sections 5.4.1 and 5.4.2."""
    want = {"g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g",
            "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s",
            "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x",
            "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/",
            "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/",
            "../../g": "http://a/g", "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g",
            "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..",
            "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h",
            "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
            "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/../x": "http://a/b/c/g#s/../x"}
    df = spark.createDataFrame([("http://a/b/c/d;p?q", h) for h in want], "base string, href string")
    assert {r.href: r.u for r in df.select("href", G.resolve_url("base", "href").alias("u")).collect()} == want


def test_links_in_every_quoting(spark):
    html = ("<a href=\"/a.html\">1</a><A HREF='/b.html'>2</A><a class=x href=/c.html>3</a><a data-href='/no.html'>4</a>"
            "<a\n href = \"../d.html\" rel='x'>5</a><area href='/no.html'>")
    df = spark.createDataFrame([(1, "http://h.org/x/y/z.html", html)], "page_id long, url string, html string")
    assert [(r.pos, r.dst) for r in G.extract_links(df).orderBy("pos").collect()] == [
        (0, "http://h.org/a.html"), (1, "http://h.org/b.html"), (2, "http://h.org/c.html"), (3, "http://h.org/x/d.html")]


def test_crawl_queue_keeps_its_budget(spark):
    links = spark.createDataFrame([("a", "c", 0), ("a", "b", 1), ("b", "d", 0), ("c", "a", 0), ("c", "e", 1), ("c", "b", 2),
                                   ("d", "f", 0), ("e", "d", 0)], "src string, dst string, pos long")
    seeds = spark.createDataFrame([("a", 0), ("a", 3), ("z", 1)], "url string, ord long")

    def queue(n, m):
        return [(r.url, r.round) for r in G.crawl_queue(links, seeds, n, m).orderBy("pos").collect()]

    # a finds c and b, z has no links; then c finds e and b finds d.
    assert queue(2, 2) == [("a", 0), ("z", 0), ("c", 1), ("b", 1), ("e", None), ("d", None)]
    assert queue(1, 0) == [("a", None), ("z", None)]
    assert [u for u, _ in queue(8, 20)] == ["a", "z", "c", "b", "e", "d", "f"]
