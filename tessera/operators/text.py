"""Text operators: word counts (AGG-16..19, AGG-24/25) and the positional
concordance (TXT-01..04).

Texts are processed whole: ``explode`` turns each document into token rows
inside the scan stage, and counting is a partial + final aggregate, so a
large document costs one task's worth of tokens and never a driver trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import text as T


def word_count(df: DataFrame, text: str = "text", clean: bool = False, keep_empty: bool = False) -> DataFrame:
    """(word, count), most frequent first with the word as tie-break
    (AGG-16).  ``clean`` applies the reference cleaner (AGG-19)."""
    toks = T.clean_tokens(text, keep_empty) if clean else T.tokens(text, keep_empty)
    w = df.select(F.explode(toks).alias("word"))
    return w.groupBy("word").count().orderBy(F.col("count").desc(), "word")


def word_document_frequency(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Number of distinct documents each word occurs in (AGG-25).  Words are
    first made distinct per document (map-side within each document row), so
    the shuffle carries at most one row per (document, word)."""
    per_doc = df.select(doc, F.explode(F.array_distinct(T.clean_tokens(text))).alias("word"))
    return per_doc.groupBy("word").agg(F.count(F.lit(1)).alias("documents"))


def words_per_group_with_total(df: DataFrame, group, text: str) -> DataFrame:
    """Word total per group plus a grand-total row with a null group (AGG-24):
    one ``rollup`` instead of two chained jobs."""
    counted = df.select(group, T.word_total(text).alias("_w"))
    return counted.rollup(group).agg(F.sum("_w").cast("bigint").alias("words"))


# The word pattern of the concordance parser, the characters
# each variant strips from a word, and the page separator.
WORD = r"[\w’]+[,;.\-?!]?"
WORD_UNICODE = r"[\p{L}\p{M}\p{N}_’]+[,;.\-?!]?"
STRIP_STRICT = r"[,;.\-?!—]"
STRIP_RANGE = r"[.,;-?!]"  # ';-?' is a character range here, so '-' stays
PAGE_BREAK = "/p"


def _by_repeats(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is theirs alone, and those whose key repeats (null
    is a key).  The first need no group: what is kept per key is kept within
    the row, and only whole texts are shuffled and sorted."""
    n = df.select(key, text, F.count(F.lit(1)).over(W.partitionBy(key)).alias("_n"))
    return n.where("_n = 1").drop("_n"), n.where("_n > 1").drop("_n")


def _matches(line, word: str) -> Column:
    """The words of a valid line, each with its leading blanks."""
    return F.regexp_extract_all(line, F.lit(r"\s*" + word), 0)


def _tokens_at(line, word: str) -> Column:
    """(at, m) of each match of a valid line, ``at`` being the total length of
    the matches before it."""
    return T.let(_matches(line, word), lambda ms: F.arrays_zip(T.offsets(ms).alias("at"), ms.alias("m")))


def _is_valid(line, word: str) -> Column:
    """True if nothing but words and white space is on the line (TXT-02)."""
    return F.regexp_replace(line, word, "").rlike(r"^\s*$")


def _position_and_word(at, m, strip: str) -> tuple[Column, Column]:
    tok = F.ltrim(m, F.lit(" \t\n\x0B\f\r"))  # what Java's \s is
    col = (at + F.length(m) - F.length(tok) + 1).cast("int")
    return col.alias("col"), F.lower(F.regexp_replace(tok, strip, "")).alias("word")


def concordance(df: DataFrame, doc: str = "doc_id", text: str = "text", mode: str = "strict",
                strip: str = STRIP_STRICT, per_doc: bool = False) -> DataFrame:
    """Positional word index: (doc, page, line, col, word) (TXT-01..04).

    Pages are split on ``/p`` and lines on newlines (both numbered from 1).
    A line is all-or-nothing (TXT-02): if anything but words and white space
    remains once the words are removed, the line yields no words.  That
    check is linear; a single anchored repetition regex could backtrack
    exponentially on long lines.  ``col`` is the 1-based character position
    of the word: one plus the lengths of the earlier matches (which carry
    their leading blanks) plus this match's leading blanks.  Those lengths
    are summed inside the line's row, so words stream out of the texts and
    none is shuffled, sorted or held in a window.  Only where a ``doc``
    repeats do its texts share lines: there a window orders their words.

    ``mode='strict'`` uses ASCII word characters like the reference, so lines
    with accented letters vanish; ``mode='unicode'`` accepts any letter.
    ``strip`` picks the punctuation removed from each word (TXT-04 uses the
    range variant, which keeps '-').

    ``per_doc`` gives the same index as one row per document, (doc, entries),
    for :func:`concordance_nested`; an only text's entries are made within
    its row instead of sorting every word by document."""
    word = WORD if mode == "strict" else WORD_UNICODE
    single, repeated = _by_repeats(df, doc, text)
    shared = _shared_lines(_lines(repeated, doc, text, word), doc, word, strip)
    if per_doc:
        # explode of at most one array: a document without words has no row
        entries = F.filter(F.array(_entries(F.col(text), word, strip)), lambda e: F.size(e) > 0)
        return single.select(doc, F.explode(entries).alias("entries")).unionByName(concordance_nested(shared, doc))
    tokens = _lines(single, doc, text, word).select(doc, "page", "line", F.explode(_tokens_at("_line", word)).alias("_t"))
    return tokens.select(doc, "page", "line", *_position_and_word(F.col("_t.at"), F.col("_t.m"), strip)).unionByName(shared)


def _lines(df: DataFrame, doc: str, text: str, word: str) -> DataFrame:
    """The valid lines of every page: (doc, page, line, _line)."""
    pages = df.select(doc, F.posexplode(F.split(text, PAGE_BREAK)).alias("_p", "_ptext"))
    lines = pages.select(doc, (F.col("_p") + 1).cast("int").alias("page"),
                         F.posexplode(F.split("_ptext", "\n")).alias("_l", "_line"))
    return lines.where(_is_valid("_line", word)).select(
        doc, "page", (F.col("_l") + 1).cast("int").alias("line"), "_line")


def _shared_lines(lines: DataFrame, doc: str, word: str, strip: str) -> DataFrame:
    """The index of documents that come in several rows: a line's words are
    those of all rows, placed after each other by their number in the line."""
    words = lines.select(doc, "page", "line", F.posexplode(_matches("_line", word)).alias("_k", "_m"))
    w = W.partitionBy(doc, "page", "line").orderBy("_k").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("_m")).over(w), F.lit(0))
    return words.select(doc, "page", "line", *_position_and_word(before, F.col("_m"), strip))


def _entries(text: Column, word: str, strip: str) -> Column:
    """The (page, line, col, word) entries of one text, in order."""
    def of_line(line: Column, p: Column, k: Column) -> Column:
        found = F.transform(_tokens_at(line, word), lambda t: F.struct(
            (p + 1).alias("page"), (k + 1).alias("line"), *_position_and_word(t["at"], t["m"], strip)))
        return F.when(_is_valid(line, word), found).otherwise(
            F.array().cast("array<struct<page:int,line:int,col:int,word:string>>"))

    def of_page(page: Column, p: Column) -> Column:
        return F.flatten(F.transform(F.split(page, "\n"), lambda line, k: of_line(line, p, k)))

    return F.flatten(F.transform(F.split(text, PAGE_BREAK), of_page))


def concordance_nested(index: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Nested view: one row per document with its ordered (page, line, col,
    word) entries (TXT-03), from the flat index or from the one made
    ``per_doc``, which spares the sort of all words by document.  A
    document's entry list is bounded by the document's own text, which
    already sits in one row."""
    if "entries" in index.columns:
        return index.select(doc, F.array_sort("entries").alias("entries"))
    entries = F.array_sort(F.collect_list(F.struct("page", "line", "col", "word")))
    return index.groupBy(doc).agg(entries.alias("entries"))


def word_value_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """``countByValue`` per key as a map ``word -> count`` (AGG-18).  An only
    text's words are counted inside its row, so that no word is shuffled,
    sorted or held in a hash table; those of a key that repeats are grouped.
    The map of one key is bounded by that key's own text (a document), so no
    unbounded group is gathered; a corpus-wide map would be the (word,
    count) frame of :func:`word_count` itself."""
    single, repeated = _by_repeats(df, key, text)
    # explode of at most one array: a key without words has no row
    counted = F.filter(F.array(T.value_counts(T.tokens(text))), lambda c: F.size(c) > 0)
    within = single.select(key, F.explode(counted).alias("_entries"))
    w = repeated.select(key, F.explode(T.tokens(text)).alias("word")).groupBy(key, "word").count()
    grouped = w.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("word", "count"))).alias("_entries"))
    return within.unionByName(grouped).select(key, F.map_from_entries("_entries").alias("counts"))
