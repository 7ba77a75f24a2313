"""Quality rules (operator 7): learned decision lists over document
statistics, with DataFrame functions only.

Statistics are in-row expressions over whole texts: one scan, no shuffle.
Rules are learned by sequential covering on a bounded sample of labelled
documents (``SAMPLE`` of them, those with the smallest hash of their id): a
rule is grown as a conjunction of thresholds by information gain on two thirds
of the sample, pruned from its end on the last third, kept if it is precise
there, and the bad documents it covers are taken out before the next one is
grown.  The list becomes an ordered Spark conditional expression whose first
matching rule decides; documents that none matches are kept.

Covering works on whole sets of sample rows as the bits of an integer, so a
condition is tried by one AND.

Defined cases: null text has no words (every statistic 0, ``base_failed``);
rows without a label, or with conflicting ones (the higher counts), are no
obstacle; without labelled rows of both kinds there are no rules and
``base_failed`` alone decides; repeated rows give repeated results; empty
tables give empty results; other columns are ignored by :func:`judge` and kept
by :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample

SAMPLE = 20_000
WINDOW = 8
WHITE = r"[\x20\x09-\x0D]+"  # fixed: the white space that separates words
SYMBOLS = r"[#*$%&|<>]"  # fixed: the symbols that are counted
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def add_statistics(docs: DataFrame, text_col: str = "text", prefix: str = "__q_") -> DataFrame:
    """``docs`` with the base statistics (names prefixed) and the further
    ones that rules may use."""
    def p(n):
        return F.col(prefix + n)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.withColumn(prefix + "words", F.filter(F.split(text, WHITE, -1), lambda w: w != ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    d = d.withColumns({
        prefix + "lines": lines,
        prefix + "hashes": F.transform(p("words"), lambda w: F.xxhash64(w)),
        prefix + "n_words": F.size(p("words")).cast("long"),
        prefix + "word_chars": F.length(F.array_join(p("words"), "")).cast("long"),
        prefix + "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        prefix + "n_upper": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
    })
    # A window is named by a hash of its words' hashes.
    last = p("n_words").cast("int") - (WINDOW - 1)
    windows = F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                           lambda i: F.xxhash64(F.slice(p("hashes"), i, WINDOW))))
    d = d.withColumns({
        prefix + "windows": windows,
        prefix + "n_lines": F.size(p("lines")).cast("long"),
        prefix + "n_dup_lines": (F.size(p("lines")) - F.size(F.array_distinct(p("lines")))).cast("long"),
        prefix + "n_distinct": F.size(F.array_distinct(p("hashes"))).cast("long"),
    })
    # Only texts with a repeated window sort them; words of equal windows are
    # compared, so a hash alone never decides.
    ranked = F.when(F.size(F.array_distinct(p("windows"))) < F.size(p("windows")), F.sort_array(F.transform(
        p("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.withColumn(prefix + "ranked", ranked)

    def same(a, b):
        at = lambda x: F.slice(p("words"), x["i"] + 1, WINDOW)
        return (a["h"] == b["h"]) & (at(a) == at(b))

    twice = F.sort_array(F.transform(F.filter(p("ranked"), lambda s, i: (
        F.coalesce(same(s, F.get(p("ranked"), i - 1)), F.lit(False))
        | F.coalesce(same(s, F.get(p("ranked"), i + 1)), F.lit(False)))), lambda s: s["i"]))
    d = d.withColumn(prefix + "twice", twice)
    # Sorted starts of repeated windows: each covers its words up to the next start.
    covered = F.aggregate(
        F.transform(p("twice"), lambda s, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(p("twice"), i + 1) - s, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn(prefix + "n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    # One row each through a generator: a filter on a statistic is not pushed
    # below it, where the optimizer would write out every step again.
    counts = [c for c in d.columns if c.startswith(prefix + "n_") or c == prefix + "word_chars"]
    return d.select(*docs.columns, F.inline(F.array(F.struct(*counts))))


def base_failed(prefix: str = "__q_") -> Column:
    n = F.col(prefix + "n_words")
    return (n < 20) | (100 * F.col(prefix + "n_repeat_words") > 30 * n)


def measures(prefix: str = "__q_") -> dict[str, Column]:
    """What rules put thresholds on."""
    def ratio(a, b):
        return F.coalesce(F.col(prefix + a) / F.when(F.col(prefix + b) > 0, F.col(prefix + b)), F.lit(0.0))

    return {"symbols_a_char": ratio("n_symbols", "word_chars"), "upper_a_char": ratio("n_upper", "word_chars"),
            "chars_a_word": ratio("word_chars", "n_words"), "distinct_words": ratio("n_distinct", "n_words"),
            "repeated_words": ratio("n_repeat_words", "n_words"), "repeated_lines": ratio("n_dup_lines", "n_lines"),
            "words_a_line": ratio("n_words", "n_lines")}


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    bound: float

    def column(self, measures_: dict[str, Column]) -> Column:
        c = measures_[self.measure]
        return c > self.bound if self.above else c <= self.bound

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.bound:.6g}"


def conditions(rows: list[dict[str, float]], bins: int) -> dict[Condition, int]:
    """Every threshold condition with the rows it holds for, as bits."""
    out = {}
    for name in rows[0] if rows else ():
        order = sorted(range(len(rows)), key=lambda i: rows[i][name])
        values = [rows[i][name] for i in order]
        below, i = 0, 0
        everything = (1 << len(rows)) - 1
        cuts = sorted({values[min(len(rows) - 1, len(rows) * b // bins)] for b in range(bins)})
        for low, high in zip(cuts, cuts[1:] or []):
            while i < len(values) and values[i] <= low:
                below |= 1 << order[i]
                i += 1
            nxt = values[i] if i < len(values) else high
            bound = (low + nxt) / 2
            if low < nxt:
                out[Condition(name, False, bound)] = below
                out[Condition(name, True, bound)] = everything & ~below
    return out


def learn(rows: list[dict[str, float]], bad: list[bool], precision: float = 0.95, max_rules: int = 24,
          max_conditions: int = 4, bins: int = 64, least: int = 3) -> list[list[Condition]]:
    """Rules for bad rows by sequential covering: grow, prune, accept."""
    n = len(rows)
    grow = sum(1 << i for i in range(n) if i % 3)
    prune = ((1 << n) - 1) & ~grow
    pos = sum(1 << i for i in range(n) if bad[i])
    neg = ((1 << n) - 1) & ~pos
    tried = conditions(rows, bins)
    rules, left = [], pos
    while left & grow and len(rules) < max_rules:
        rule, held = [], [(1 << n) - 1]
        while len(rule) < max_conditions:
            now = held[-1]
            p0, n0 = (now & left & grow).bit_count(), (now & neg & grow).bit_count()
            if not n0 or not p0:
                break
            best, gain, base = None, 0.0, log2(p0 / (p0 + n0))
            for c, bits in tried.items():
                p1 = (now & bits & left & grow).bit_count()
                if p1:
                    n1 = (now & bits & neg & grow).bit_count()
                    g = p1 * (log2(p1 / (p1 + n1)) - base)
                    if g > gain:
                        best, gain = c, g
            if best is None:
                break
            rule.append(best)
            held.append(now & tried[best])

        def worth(bits):
            a, b = (bits & left & prune).bit_count(), (bits & neg & prune).bit_count()
            return (a - b) / (a + b) if a + b else -1.0

        if not rule:
            break
        keep = max(range(1, len(rule) + 1), key=lambda k: (worth(held[k]), -k))
        bits = held[keep]
        a, b = (bits & left).bit_count(), (bits & neg).bit_count()
        good = (bits & left & prune).bit_count(), (bits & neg & prune).bit_count()
        if a < least or a < precision * (a + b) or good[0] < precision * sum(good):
            break
        rules.append(rule[:keep])
        left &= ~bits
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE, **options) -> list[list[Condition]]:
    """A decision list for label 0, from at most ``sample`` labelled documents."""
    some = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y"))
            .where("__id is not null and __y is not null").groupBy("__id").agg(F.max("__y").alias("__y")))
    some = hash_sample(some.withColumn("__h", F.xxhash64("__id")), "__h", sample).drop("__h")
    # At most ``sample`` rows of an id and a label.
    some = F.broadcast(some)
    text = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(some, "__id")
    stats = add_statistics(text, "__t")
    kept = measures()
    row = F.struct(F.col("__y").alias("y"), *[c.alias(n) for n, c in kept.items()])
    got = stats.groupBy("__id").agg(F.min(row).alias("r")).select("__id", "r.*").collect()
    got.sort(key=lambda r: md5(str(r["__id"]).encode()).digest())  # in an order without meaning
    return learn([{n: float(r[n]) for n in kept} for r in got], [r["y"] == 0 for r in got], **options)


def verdict(rules: list[list[Condition]], prefix: str = "__q_") -> Column:
    """The ordered conditional expression: the number (from 1) of the first
    rule that a document meets, null if none."""
    m, out = measures(prefix), F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        met = rule[0].column(m)
        for c in rule[1:]:
            met &= c.column(m)
        out = F.when(met, k).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[list[Condition]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, base statistics, base_failed, kept, rule) for each row."""
    p = "__q_"
    d = add_statistics(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")), "__t", p)
    d = d.select("__id", *[F.col(p + n).alias(n) for n in BASE], base_failed(p).alias("base_failed"),
                 verdict(rules, p).alias("rule"))
    return d.select(F.col("__id").alias(id_col), *BASE, "base_failed",
                    (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def keep(docs: DataFrame, rules: list[list[Condition]], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base rules nor a learned one reject."""
    p = "__q_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p = "_" + p
    d = add_statistics(docs, text_col, p)
    return d.where(~base_failed(p) & verdict(rules, p).isNull()).select(*docs.columns)
