"""Secret scans (operator 6) through a trigram inverted index, with DataFrame
functions only.

Each rule's regular expression gives a Boolean trigram query: trigrams that
every match must hold, as alternatives of sets (after R. Cox, "Regular
Expression Matching with a Trigram Index", 2012).  The index holds postings
(trigram, document) of lower-cased texts for the trigrams the rules ask for;
intersecting the postings of a document's trigrams with the queries gives
(document, rules) candidates, and only there are the expressions run.  Rules
without mandatory trigrams scan every text.

Positions come from cutting a text at the matches: lengths of the pieces and
of the matches, summed in order, are the starts, in code points.

Defined cases: null text counts as empty; documents are joined by a hash of
(id, text), so null ids and repeated rows work, and repeated rows give
repeated results; an empty table gives an empty result; other columns are
ignored by :func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import fresh, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches, left to right without overlap; those with
    fewer than ``least`` characters (of ``group``) are dropped."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The base rules, then public token formats.  In the hex rule
# the least length stands in the pattern: maximal runs of 16 or more are the
# same matches, without listing every short run.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{0,15}://[^\s/:@]+:[^\s/:@]+@"),
)

MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Conditions that the trigrams of a lower-cased text with a match meet:
    all of them, each as alternatives of sets of trigrams.  Empty: no
    mandatory trigram is known."""
    from re import _parser  # the standard library's own reader of expressions

    query: list[list[frozenset[str]]] = []

    def grams(s: str) -> frozenset[str]:
        return frozenset(s[i:i + 3] for i in range(len(s) - 2))

    def ask(strings: set[str]) -> None:
        sets = {grams(s) for s in strings}
        if all(sets):
            # A set that holds another one adds nothing to the alternatives.
            query.append(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted))

    def exact(items) -> set[str] | None:
        """All strings an expression stands for, if they are few."""
        out = {""}
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                one = {chr(arg).lower()} if arg < 128 else None
            elif name == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
                # A set is exact as a whole or not at all.  Beyond ASCII the lower case of a character
                # depends on its neighbours and on the engine, so no trigram is asked for.
                spans = [(a, a) if str(o) == "LITERAL" else a for o, a in arg]
                one = ({chr(c).lower() for a, b in spans for c in range(a, b + 1)}
                       if all(b < 128 for _, b in spans) else None)
            elif name == "SUBPATTERN":
                one = exact(arg[3])
            elif name == "BRANCH":
                branches = [exact(b) for b in arg[1]]
                one = None if None in branches else set().union(*branches)
            elif name == "MAX_REPEAT" and arg[1] == 1:
                one = exact(arg[2])
                one = None if one is None else one | ({""} if arg[0] == 0 else set())
            else:
                one = None
            if one is None or len(out) * len(one) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in one}
        return out

    run = {""}
    for item in _parser.parse(pattern):
        one = exact([item])
        if one is not None and len(run) * len(one) <= MOST_STRINGS:
            run = {a + b for a in run for b in one}
        else:
            ask(run)
            run = one if one is not None else {""}
    ask(run)
    return query


def vocabulary(rules) -> list[str]:
    return sorted({g for r in rules for either in trigram_query(r.pattern) for s in either for g in s})


def postings(docs: DataFrame, grams: list[str], key: str = "k", text: str = "t") -> DataFrame:
    """(gram, k): the inverted index of the given trigrams."""
    low = docs.select(key, F.lower(text).alias("_l"))
    held = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col("_l"), g))
    return low.select(key, F.explode(held).alias("gram"))


def candidates(index: DataFrame, rules) -> DataFrame:
    """(k, rules): for each document with postings, the rules whose query its
    trigrams meet.  A document's posting lists are met by grouping them, with
    one Boolean for each trigram, summed before the shuffle."""
    grams = vocabulary(rules)
    has = index.groupBy("k").agg(*[F.max(F.col("gram") == g).alias(f"g{i}") for i, g in enumerate(grams)])
    at = {g: F.col(f"g{i}") for i, g in enumerate(grams)}
    met = []
    for i, r in enumerate(rules):
        query = trigram_query(r.pattern)
        if query:
            ok = reduce(and_, [reduce(or_, [reduce(and_, [at[g] for g in sorted(s)]) for s in either]) for either in query])
            met.append(F.when(ok, F.lit(i)))
    found = F.array_compact(F.array(*met)) if met else F.array().cast("array<int>")
    return has.select("k", found.alias("rules")).where(F.size("rules") > 0)


def scan_keyed(docs: DataFrame, rules=RULES) -> DataFrame:
    """(k, rule, start, end): verified spans of (k, t) rows."""
    if vocabulary(rules):
        found = docs.join(candidates(postings(docs, vocabulary(rules)), rules), "k", "left")
    else:
        found = docs.withColumn("rules", F.lit(None).cast("array<int>"))
    text = found
    for i, r in enumerate(rules):
        all_of = F.regexp_extract_all("t", F.lit(r.pattern), F.lit(0))
        wanted = F.lit(True) if not trigram_query(r.pattern) else F.array_contains("rules", i)
        text = text.withColumn(f"m{i}", F.when(wanted, all_of))
    for i, r in enumerate(rules):
        text = text.withColumn(f"p{i}", F.when(F.size(f"m{i}") > 0, F.split("t", r.pattern, -1)))

    def lengths(i: int, r: Rule) -> Column:
        def one(m, j):
            measured = F.length(F.regexp_extract(m, r.pattern, r.group)) if r.group else F.length(m)
            return F.struct(F.lit(i).alias("rule"), j.cast("long").alias("nth"),
                            F.length(F.get(F.col(f"p{i}"), j)).cast("long").alias("gap"),
                            F.length(m).cast("long").alias("size"), (measured >= r.least).alias("ok"))
        return F.when(F.size(f"m{i}") > 0, F.transform(f"m{i}", one)).otherwise(
            F.array().cast("array<struct<rule:int,nth:bigint,gap:bigint,size:bigint,ok:boolean>>"))

    rows = text.select("k", F.explode(F.concat(*[lengths(i, r) for i, r in enumerate(rules)])).alias("x"))
    rows = rows.select("k", "x.*").distinct()  # rows that repeat a document are scanned alike
    order = W.partitionBy("k", "rule").orderBy("nth").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    return rows.select("k", "rule", end.alias("end"), "size", "ok").where("ok").select(
        "k", "rule", (F.col("end") - F.col("size")).alias("start"), "end")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), text.alias("t")).withColumn("k", F.xxhash64("id", "t"))


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, found) for each row: its spans as an array of (start, rule,
    end), by start and then by the order of the rules."""
    d = keyed(docs, id_col, text_col)
    spans = scan_keyed(d.select("k", "t"), rules).groupBy("k").agg(
        F.sort_array(F.collect_list(F.struct("start", "rule", "end"))).alias("found"))
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>")
    return d.select("id", "k").join(spans, "k", "left").select(
        F.col("id").alias(id_col), F.coalesce("found", none).alias("found"))


def redact(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span of its texts replaced by ``mark`` (overlapping
    spans by one) and ``length_col`` set anew.  Null texts stay null."""
    key = fresh("__key", docs)
    found, differs = fresh("__spans", docs), fresh("__changed", docs)
    d = docs.withColumn(key, F.xxhash64(F.col(id_col), text_or_empty(text_col)))
    spans = scan_keyed(d.select(F.col(key).alias("k"), text_or_empty(text_col).alias("t")), rules)
    before = W.partitionBy("k").orderBy("start", "rule").rowsBetween(W.unboundedPreceding, -1)
    clear = (spans.withColumn("far", F.coalesce(F.max("end").over(before), F.lit(-1).cast("long")))
             .where(F.col("end") > F.col("far")))
    parts = clear.groupBy(F.col("k").alias(key)).agg(F.sort_array(F.collect_list(F.struct(
        F.greatest("start", "far").alias("a"), F.col("end").alias("b"), (F.col("start") >= F.col("far")).alias("new"))
    )).alias(found))
    s, t = F.col(found), F.col(text_col)
    kept = F.transform(s, lambda x, i: F.concat(
        F.substr(t, (F.coalesce(F.get(s, i - 1)["b"], F.lit(0)) + 1).cast("int"),
                 (x["a"] - F.coalesce(F.get(s, i - 1)["b"], F.lit(0))).cast("int")),
        F.when(x["new"], F.lit(mark)).otherwise(F.lit(""))))
    clean = F.concat(F.array_join(kept, ""), F.substr(t, (F.element_at(s, -1)["b"] + 1).cast("int")))
    changed = F.col(found).isNotNull()
    out = (d.join(parts, key, "left").withColumn(differs, changed)
           .withColumn(text_col, F.when(changed, clean).otherwise(t)))
    if length_col and length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.col(differs), F.length(text_col)).otherwise(F.col(length_col))
                             .cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)


def digests(found: DataFrame, rules=RULES, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, and base and all spans as text."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = [i for i, r in enumerate(rules) if r.base]

    def of_rule(i):
        return F.size(F.filter("found", lambda s: s["rule"] == i)).cast("long")

    counts = [of_rule(i).alias(f"n_{rules[i].kind}") for i in base]
    return found.select(
        id_col, *counts,
        F.sha2(listed(F.filter("found", lambda s: s["rule"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"))
