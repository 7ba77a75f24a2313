"""Text column functions: tokenising and cleaning (SCL-17, AGG-19).

All are native Column expressions (Java regex inside codegen), never UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space as Java's ``\s`` defines it, and the
# characters the word-count cleaner strips: , . ! ? : ; ( ) % $ ' -
WHITESPACE = r"[\t\n\x0B\f\r ]"
STRIP_CHARS = r"[,.!?:;()%$'-]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java_trim(col) -> Column:
    """``String.trim``: drop leading/trailing chars <= U+0020 (``F.trim``
    only removes spaces)."""
    return F.regexp_replace(_c(col), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def tokens(col, keep_empty: bool = False) -> Column:
    """Split on runs of white space; empty tokens removed unless asked for."""
    arr = F.split(_c(col), WHITESPACE + "+")
    return arr if keep_empty else F.filter(arr, lambda x: x != "")


def clean_token(tok) -> Column:
    """Strip punctuation, trim, lower-case one token (the reference cleaner)."""
    return F.lower(java_trim(F.regexp_replace(_c(tok), STRIP_CHARS, "")))


def clean_tokens(col, keep_empty: bool = False) -> Column:
    """Split on single white-space characters and clean each token.  The
    reference keeps tokens that clean to ``""``; pass ``keep_empty=True`` for
    that, the default drops them."""
    arr = F.transform(F.split(_c(col), WHITESPACE), clean_token)
    return arr if keep_empty else F.filter(arr, lambda x: x != "")


def word_total(col) -> Column:
    """Number of white-space separated words in a text."""
    return F.size(F.regexp_extract_all(_c(col), F.lit(r"[^\t\n\x0B\f\r ]+"), 0))


def strip_tags(col) -> Column:
    """Replace HTML/XML tags by a blank."""
    return F.regexp_replace(_c(col), r"<[^>]*>", " ")


def url_host(col) -> Column:
    """Server host of a URL (SCL-23); null for text that is not a URL."""
    return F.try_parse_url(_c(col), F.lit("HOST"))


def let(value, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body
    names it (lambda bodies share no common subexpressions)."""
    return F.transform(F.array(_c(value)), body)[0]


def offsets(parts) -> Column:
    """Where each string of an array begins in their concatenation, from 0:
    the total length of the strings before it.

    A running sum inside the row: nothing is exploded, sorted or windowed.
    Sums of 1, 2, 4, ... neighbours are added up, in as many passes as the
    array's size has binary digits (an array grown item by item would be
    copied for each)."""
    def sums(n: Column) -> Column:
        shifts = F.filter(F.array(*[F.lit(1 << j) for j in range(31)]), lambda s: s < F.size(n))
        return F.aggregate(shifts, n, lambda a, s: F.transform(a, lambda x, i: x + F.coalesce(F.get(a, i - s), F.lit(0))))

    def begins(n: Column) -> Column:
        return let(sums(n), lambda ends: F.transform(n, lambda x, i: F.get(ends, i) - x))

    return let(F.transform(_c(parts), lambda x: F.length(x)), begins)


def value_counts(items) -> Column:
    """(word, count) of each distinct string of an array, by word: the sorted
    array's runs, from the begin of one to the begin of the next."""
    def runs(s: Column) -> Column:
        n = F.size(s)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        begins = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(begins, lambda b: F.transform(b, lambda at, i: F.struct(
            F.get(s, at).alias("word"), (F.coalesce(F.get(b, i + 1), n) - at).cast("bigint").alias("count"))))

    return let(F.sort_array(_c(items)), runs)
