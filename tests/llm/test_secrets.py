import hashlib
import random
import re

from pyspark.sql import functions as F

from tessera.llm import secret_scan as S


def plain_spans(text):
    out = []
    for i, rule in enumerate(S.RULES):
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), i, m.end()))
    return sorted(out)


def texts():
    r = random.Random(3)
    bits = ["password", "PassWd", "secret=", "token", "api_key", "APIKEY", ":", "=", " ", "'", '"', "abcdefghijkl", "0123456789abcdef",
            "AKIA", "ABCDEFGHIJKLMNOP", "é", "中", "\n", "deadbeef", "ghp_" + "a1B2" * 9, "xoxb-1234567890ab", "AIza" + "x" * 35,
            "https://user:pw@host", "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJ.eyJzdWIiOiIx.abcdefghij", "==", "passwd:", "x"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(400)] + [
        "", "token=passwd:abcdefghijklmnop", "AKIAAKIA" + "A" * 14, "secret" * 50 + "=" + "a" * 40]


def test_spans_against_plain_scan(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.found] for r in S.scan(df).collect()}
    assert got == {i: plain_spans(t) for i, t in rows}
    assert sum(map(len, got.values())) > 200
    one = {r.doc_id: r for r in S.digests(S.scan(df)).collect()}
    for i, t in rows[:60]:
        spans = plain_spans(t)
        name = lambda s: f"{S.RULES[s[1]].kind}:{s[0]}:{s[2]}"
        assert one[i].spans == ",".join(map(name, spans))
        base = ",".join(name(s) for s in spans if s[1] < 3)
        assert one[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (one[i].n_assign, one[i].n_access, one[i].n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))


def test_every_match_meets_its_trigram_query():
    for rule in S.RULES:
        for text in texts():
            if re.search(rule.pattern, text):
                low = text.lower()
                assert all(any(all(g in low for g in s) for s in either) for either in S.trigram_query(rule.pattern))
    assert S.trigram_query("[0-9a-f]+") == [] and S.trigram_query("a?b*") == []


def test_wide_ranges_and_letters_beyond_ascii():
    for pattern, text in [("[\u0100-\u0200]bc[0-9]+", "x\u0190bc12"), ("[ -~]bcd", "\u007ezbcd"), ("[!-\u00ff]abc", "\u00fbabc"),
                          ("a[A-z]{0,1}bcd", "azbcd"), ("\u03a3abc", "\u03a3abc"), ("ab\u0130cd", "ab\u0130cd")]:
        assert re.search(pattern, text)
        grams = {text.lower()[i:i + 3] for i in range(len(text.lower()) - 2)}
        assert all(any(s <= grams for s in either) for either in S.trigram_query(pattern)), pattern


def test_matches_of_random_expressions_meet_their_queries():
    r = random.Random(12)

    def expression(depth):
        kind = r.randint(0, 7 if depth else 3)
        if kind <= 1:
            return "".join(r.choice("abAB1_\u00e9\u03a3") for _ in range(r.randint(1, 4)))
        if kind == 2:
            a, b = sorted(r.sample(range(48, 500 if r.random() < 0.3 else 122), 2))
            return f"[{re.escape(chr(a))}-{re.escape(chr(b))}]"
        if kind == 3:
            return "[" + "".join(r.sample("abcdXYZ019", r.randint(1, 4))) + "]"
        if kind == 4:
            return "(" + "|".join(expression(depth - 1) for _ in range(r.randint(2, 3))) + ")"
        if kind == 5:
            return f"({expression(depth - 1)})" + r.choice(["?", "*", "+", "{2}", "{0,1}", "{1,3}"])
        return expression(depth - 1) + expression(depth - 1)

    def example(pattern):
        """A string that the parsed expression stands for."""
        out = ""
        for op, arg in pattern:
            name = str(op)
            if name == "LITERAL":
                out += chr(arg)
            elif name == "IN":
                o, a = r.choice(arg)
                out += chr(a if str(o) == "LITERAL" else r.randint(*a))
            elif name == "SUBPATTERN":
                out += example(arg[3])
            elif name == "BRANCH":
                out += example(r.choice(arg[1]))
            elif name == "MAX_REPEAT":
                out += "".join(example(arg[2]) for _ in range(r.randint(arg[0], min(arg[1], arg[0] + 2))))
        return out

    from re import _parser

    checked = 0
    for _ in range(6000):
        pattern = expression(3)
        text = "x" + example(_parser.parse(pattern)) + "y"
        if not re.search(pattern, text):
            continue
        low = text.lower()
        grams = {low[i:i + 3] for i in range(len(low) - 2)}
        for either in S.trigram_query(pattern):
            checked += 1
            assert any(s <= grams for s in either), (pattern, text)
    assert checked > 300


def test_redaction_and_edges(spark, odd_docs, no_docs):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    for r in S.redact(df).collect():
        text, out, end = rows[r.doc_id][1], "", 0
        for a, _, b in plain_spans(text):
            if b > end:
                if a >= end:
                    out += text[end:a] + "[SECRET]"
                end = b
        out += text[end:]
        assert r.text == out and r.n_chars == len(out)
    back = S.redact(odd_docs)
    assert back.columns == odd_docs.columns
    key = lambda r: str(r)
    kept = lambda d: sorted(map(tuple, d.where("doc_id is null or doc_id <> 9").collect()), key=key)
    assert kept(back) == kept(odd_docs)
    assert "abcdefghijkl" not in back.where("doc_id = 9").first().text
    assert S.scan(odd_docs).count() == odd_docs.count()
    assert S.scan(no_docs).count() == 0 and S.redact(no_docs).count() == 0


def test_main_path_has_no_python(spark, odd_docs):
    plan = S.digests(S.scan(odd_docs))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
    assert S.redact(odd_docs).where(F.lit(False)).columns == odd_docs.columns
