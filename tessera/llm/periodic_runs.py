"""Periodic runs of words (operator 13), found by descending-LCP Kruskal.

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are identical), of length at least ``max(6, 4 * q)``, that no
neighbouring word extends keeping period ``q``.

Method.  The suffixes of a text are sorted by prefix doubling; neighbours in
that order have a longest common prefix (LCP).  Neighbours are united by
decreasing LCP with union-find; each class keeps its positions in order.  When
two classes unite at LCP ``l``, positions that become adjacent in the united
order have an LCP of exactly ``l``; if they lie ``q <= l / 3`` apart, the words
from the first on repeat with period ``q`` for ``l + q`` words, which is a run
unless the word before it also fits (then an earlier position seeds it).  Every
run is seeded so: its first two occurrences ``q`` apart have LCP ``length - q
>= 3 * q``, and a class member between them would make a smaller period.
Classes with an LCP under five, the least that can seed a run, are not united,
and texts in which no five words occur twice are not sorted.

Each text is the work of one task, with no shuffle at all; texts go through
numpy in slices of a few megabytes (a longer text is a slice of its own, which
takes memory of some 4 * log2(words) bytes a word).

Defined cases: a null text has no words, no runs and the collapsed text "";
null and repeated ids and repeated rows are kept, one result a row; an empty
table gives an empty result; columns other than the id and the text are
ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty
from tessera.llm.words import text_slices

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
#: The least LCP that seeds a run: length 6 with period 1.
LEAST_LCP = LEAST_LENGTH - 1


def suffix_lcp(ids, doc, end):
    """Suffix order and LCPs of several texts at once: ``ids`` are word
    numbers, ``doc`` the text of each word, ``end`` the place behind the last
    word of its text.  Returns neighbours (a, b) in suffix order within a text
    and their LCP."""
    import numpy as np

    n = len(ids)
    here = np.arange(n, dtype=np.int64)
    # A rank is the place of the first member of a class in suffix order.
    key = doc * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    change = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(change, here, 0))
    levels = [rank.astype(np.int32)]
    size = np.bincount(rank, minlength=n)
    active = np.flatnonzero(size[rank] > 1)
    step = 1
    while len(active):
        ahead = active + step
        second = np.where(ahead < end[active], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        place = np.arange(len(active))
        first = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), place, 0))
        change = np.concatenate(([True], key[1:] != key[:-1]))
        sub = np.maximum.accumulate(np.where(change, place, 0))
        rank[active] = old + sub - first
        levels.append(rank.astype(np.int32))
        shared = ~change
        shared[:-1] |= ~change[1:]
        active = active[shared]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = here
    a, b = order[:-1], order[1:]
    same = doc[a] == doc[b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < end[a]) & (y < end[b])
        level = levels[t]
        equal = inside & (level[np.minimum(x, n - 1)] == level[np.minimum(y, n - 1)])
        lcp[equal] += 1 << t
    return a, b, lcp


def kruskal_seeds(n: int, a: list, b: list, lcp: list) -> list[tuple[int, int, int]]:
    """(position, distance, lcp) of positions that become adjacent in a class
    at a distance of at most a third of the LCP; edges come by decreasing LCP."""
    root = list(range(n))
    members: dict[int, list[int]] = {}  # of classes with two positions or more, in order
    seeds = []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y, l in zip(a, b, lcp):
        x, y = find(x), find(y)
        large, small = members.get(x) or [x], members.get(y) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        root[y] = x
        members.pop(y, None)
        members[x] = large
        reach = l // 3
        i = 0
        while i < len(small):
            # small[i:j] fall between the same two members of large.
            at = bisect_left(large, small[i])
            j = len(small) if at == len(large) else bisect_left(small, large[at], i)
            if at and small[i] - large[at - 1] <= reach:
                seeds.append((large[at - 1], small[i] - large[at - 1], l))
            if at < len(large) and large[at] - small[j - 1] <= reach:
                seeds.append((small[j - 1], large[at] - small[j - 1], l))
            if len(small) == 1:
                large.insert(at, small[0])
            i = j
        if len(small) > 1:
            large.extend(small)
            large.sort()  # merges two ordered stretches
    return seeds


def repeated_grams(ids, doc, end, width: int):
    """Texts in which some ``width`` words occur twice (by a 64-bit hash, so a
    collision only adds a text)."""
    import numpy as np

    at = np.flatnonzero(np.arange(len(ids)) + width <= end)
    key = doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[at + k].astype(np.uint64)
    order = np.argsort(key)
    twice = key[order][1:] == key[order][:-1]
    return np.unique(doc[at[order[1:][twice]]])


def runs_of(texts: list[list]) -> dict[int, list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words that has any, by
    start and period."""
    import numpy as np

    count = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(count.sum())
    if not total:
        return {}
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64, total)
    doc = np.repeat(np.arange(len(texts)), count)
    end = np.repeat(np.cumsum(count), count)
    some = repeated_grams(ids, doc, end, LEAST_LCP)
    if not len(some):
        return {}
    wanted = np.zeros(len(texts), bool)
    wanted[some] = True
    keep = wanted[doc]
    ids, doc = ids[keep], doc[keep]
    kept = np.where(wanted, count, 0)
    end = np.repeat(np.cumsum(kept), kept)
    begin = end - count[doc]
    a, b, lcp = suffix_lcp(ids, doc, end)
    high = np.flatnonzero(lcp >= LEAST_LCP)
    high = high[np.argsort(-lcp[high], kind="stable")]
    seeds = kruskal_seeds(len(ids), a[high].tolist(), b[high].tolist(), lcp[high].tolist())
    if not seeds:
        return {}
    start, period, l = np.array(seeds, np.int64).T
    before = np.maximum(start - 1, 0)
    leftmost = (start == begin[start]) | (ids[before] != ids[before + period])
    length = l + period
    good = leftmost & (length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period))
    start, period, length = start[good], period[good], length[good]
    out: dict[int, list] = {}
    for i in np.lexsort((period, start)):
        s = start[i]
        out.setdefault(int(doc[s]), []).append((int(s - begin[s]), int(length[i]), int(period[i])))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words outside every run and those of the first period of a run,
    unless another run drops them."""
    drop = bytearray(len(words))
    for s, n, q in runs:
        drop[s + q:s + n] = b"\1" * (n - q)
    return [w for w, d in zip(words, drop) if not d]


def _run(batches):
    import numpy as np
    import pyarrow as pa

    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        for part, texts in text_slices(batch, "_t"):
            words = [t.split() for t in texts]  # bytes: ASCII white space only
            found = runs_of(words)
            per_row = [found.get(i, []) for i in range(len(words))]
            flat = np.array([r for rs in per_row for r in rs], np.int64).reshape(-1, 3)
            offsets = np.concatenate(([0], np.cumsum([len(rs) for rs in per_row]))).astype(np.int32)
            struct = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind))
            text = [b" ".join(collapse(w, rs) if rs else w) for w, rs in zip(words, per_row)]
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.array([len(w) for w in words], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), struct), pa.array(text, pa.binary()).cast(pa.string())],
                names=["_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, runs, collapsed) of each row: its runs by start and
    period, and its words without the repeats, one space between."""
    src = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
    kind = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(
        _run, f"_id {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return out.withColumnRenamed("_id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the longest run and SHA-256 digests of the output of
    :func:`find_runs`."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("m"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("_best", longest)
    length = -F.col("_best.m")
    return best.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        length.alias("length"), F.col("_best.period").alias("period"),
        F.floor(1000 * length / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts with the repeats that the query's contract writes into them:
    with h the crc32 of the decimal id and g = h div 10, in every text whose h
    ends in 0 the words from place a = g % n on repeat with period
    p = 1 + (n - a) div (3 + g % 8).  Other texts, and those without an id or
    a word, stay as they are."""
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")
    return docs.withColumn(text_col, F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col(text_col)))
