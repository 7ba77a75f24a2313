"""Spelling variants by a relational trie frontier (operator 12).

Words.  Maximal runs of ``A-Z a-z U+00C0-U+00FF`` of whole texts, ASCII upper
case lowered.  Where 199 divides the crc32 of ``<doc_id>:<run>``, the run loses
its code point at crc32 % length (the contract's slips).  Words are results of
``least_length`` code points and ``least_count`` occurrences or more.

Neighbours.  Two words are near if one inserted, deleted or replaced code point
makes one from the other.  The trie of all words is a distributed table: a node
(named by the hash of its prefix) with its children, at most one a letter of
the alphabet.  The frontier holds (word, position, node, edits) states at one
depth; a level joins it with the nodes of that depth and steps to the children:
without an edit the word's own letter is followed, another letter stands for it
(only a greater one, the pair is found from its other side too), or it is
skipped (an insertion is the other word's deletion); after an edit only the
word's letters are followed.  A state whose word ends at a word's node with one
edit is a pair of neighbours.  Children carry the letters that follow them, so
a state that cannot go on is not made, and a child with a single word below is
decided at once by the hash of the rest; so there are as many levels as the
longest prefix that two words share, and long words cost no more.  Hashes only
name nodes: each pair is verified on the words themselves.

Scale.  Counts are combined in the tasks before the shuffle.  Every word passes
the root and its children, so the first two levels broadcast their nodes (at
most 91, with at most 90 children of fixed size each); below, the join is on
the node, and adaptive execution splits one that many states share.  Each
level is written to the shared checkpoint folder, so a lost executor repeats
one level.

Forms.  A word's form is its near word of largest count (ties: the smallest)
if that count is ``ratio`` times its own; its root is found by pointer
doubling, in a number of rounds that is the logarithm of a logarithm, as each
step multiplies the count.

Defined cases: a null text has no words; a null id hashes as the empty text;
repeated rows count again; an empty table gives an empty result; columns other
than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, text_or_empty
from tessera.llm.words import text_slices
from tessera.session import checkpoint_dir

RUN = "[A-Za-zÀ-ÿ]+"
ALPHABET = 26 + 64
SLIP = 199
#: Entries (and characters) of a task's table of counts before it is handed on.
HELD, HELD_CHARS = 200_000, 16 << 20


def _count_words(least_length: int, slip: int):
    def run(batches):
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa

        find = re.compile(RUN).findall
        held: Counter = Counter()
        chars = 0

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(held.keys()), pa.string()),
                                               "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for part, texts in text_slices(batch, "_t"):
                for name, text in zip(part.column("_id").to_pylist(), texts):
                    base = zlib.crc32(f"{'' if name is None else name}:".encode())
                    for word, n in Counter(find(text.lower().decode("utf-8", "replace"))).items():
                        h = zlib.crc32(word.encode(), base)
                        if h % slip == 0:
                            k = h % len(word)
                            word = word[:k] + word[k + 1:]
                        if len(word) >= least_length:
                            if word not in held:
                                chars += len(word)
                            held[word] += n
                    if len(held) > HELD or chars > HELD_CHARS:
                        yield out()
                        held.clear()
                        chars = 0
        yield out()

    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
                least_count: int = 5, slip: int = SLIP) -> DataFrame:
    """(word, n): the words of all texts and how often they occur."""
    src = docs.select(F.col(id_col).cast("string").alias("_id"), text_or_empty(text_col).alias("_t"))
    parts = src.mapInArrow(_count_words(least_length, slip), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _shared_depth(words: DataFrame) -> DataFrame:
    """(w, word, deep): a depth at which no other word shares the prefix of
    the word (or its length), at most twice the least such depth or 4."""
    size = F.length("word")
    # Prefixes of 4, 8, 16, ... letters; those of one or two letters are shared by very many words.
    last = F.floor(F.log2(size)).cast("int")
    steps = F.when(last >= 2, F.sequence(F.lit(2), last))
    at = words.select("w", "word", F.explode(steps).alias("j"))
    at = at.withColumn("p", F.xxhash64("j", F.substring("word", F.lit(1), F.expr("shiftleft(1, j)"))))
    shared = at.groupBy("p").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    most = at.select("w", "j", "p").join(shared, "p").groupBy("w").agg(F.max("j").alias("j"))
    return words.join(most, "w", "left").select(
        "w", "word", F.least(size, F.coalesce(F.expr("shiftleft(1, j + 1)"), F.lit(4))).alias("deep"))


def trie(words: DataFrame) -> DataFrame:
    """(depth, node, kids): nodes that two words or more share (and the root),
    each with its children by letter: ``c`` words below, ``term`` the word that
    ends there, and either the ``letters`` that follow or, with one word below,
    that word ``only`` and the hash ``tail`` of its rest."""
    rows = _shared_depth(words).select("w", "word", F.explode(F.sequence(F.lit(1), F.col("deep"))).alias("d"))
    rows = rows.select(
        "w", "d", F.xxhash64(F.substring("word", F.lit(1), F.col("d") - 1)).alias("parent"),
        F.xxhash64(F.substring("word", F.lit(1), F.col("d"))).alias("node"),
        F.substring("word", F.col("d"), F.lit(1)).alias("ch"), (F.length("word") == F.col("d")).alias("ends"),
        F.xxhash64(F.substring("word", F.col("d") + 1, F.length("word"))).alias("tail"))
    edges = materialize(rows.groupBy("d", "parent", "node", "ch").agg(
        F.count(F.lit(1)).alias("c"), F.max(F.when(F.col("ends"), F.col("w"))).alias("term"),
        F.min("w").alias("only"), F.min("tail").alias("tail")))
    shared = edges.where("c > 1")
    letters = edges.groupBy((F.col("d") - 1).alias("d"), F.col("parent").alias("node")).agg(
        F.array_join(F.collect_set("ch"), "").alias("letters"))  # at most one a letter of the alphabet
    follow = shared.select("d", "node").join(letters, ["d", "node"])
    kids = edges.join(follow, ["d", "node"], "left")
    inner = shared.select((F.col("d") + 1).alias("d"), F.col("node").alias("parent"))
    kids = kids.where("d = 1").unionByName(kids.join(inner, ["d", "parent"], "left_semi").where("d > 1"))
    kid = F.struct("ch", F.col("node").alias("child"), "c", "term", "only", "tail", "letters")
    return kids.groupBy((F.col("d") - 1).alias("depth"), F.col("parent").alias("node")).agg(
        F.collect_list(kid).alias("kids"))


def _step(frontier: DataFrame, nodes: DataFrame) -> DataFrame:
    """One level: (w, word, pos, node, edits, found, go) after a step to the
    children; ``found`` is a neighbour, ``go`` marks states of the next level."""
    size = F.length("word")

    def letter(k):  # of the word, k places after the state's
        return F.substring("word", F.col("pos") + 1 + k, F.lit(1))

    s = frontier.join(nodes, "node").withColumns({
        "_a": letter(0), "_b": letter(1), "_c": letter(2), "_len": size,
        "_r1": F.xxhash64(F.substring("word", F.col("pos") + 2, size)),
        "_r2": F.xxhash64(F.substring("word", F.col("pos") + 3, size))})

    def fits(k, used, rest, following):
        """An edited state may stand at child ``k`` after ``used`` more letters."""
        ends = F.col("pos") + used == F.col("_len")
        return F.when(k["c"] == 1, k["tail"] == rest).when(ends, k["term"].isNotNull()).otherwise(
            F.instr(k["letters"], following) > 0)

    def moves(test, used, edits):
        return F.transform(F.filter("kids", test), lambda k: F.struct(
            (F.col("pos") + used).alias("pos"), F.lit(edits).alias("edits"), k.alias("k")))

    a, b = F.col("_a"), F.col("_b")
    inside = F.col("pos") < F.col("_len")
    exact = F.concat(
        moves(lambda k: (k["ch"] == a) & (k["c"] > 1), 1, 0),
        moves(lambda k: (k["ch"] > a) & fits(k, 1, F.col("_r1"), b), 1, 1),
        moves(lambda k: (k["ch"] == b) & (a != b) & fits(k, 2, F.col("_r2"), F.col("_c")), 2, 1))
    edited = moves(lambda k: (k["ch"] == a) & fits(k, 1, F.col("_r1"), b), 1, 1)
    out = s.where(inside).select("w", "word", "_len", F.explode(F.when(F.col("edits") == 0, exact).otherwise(edited)).alias("m"))
    out = out.select("w", "word", "_len", "m.pos", "m.edits", "m.k.*")
    last = F.when(F.col("edits") == 1, F.col("_len")).otherwise(F.col("_len") - 1)  # the last letter may be skipped
    found = F.when((F.col("c") == 1), F.col("only")).when(F.col("pos") == last, F.col("term"))
    return out.select("w", "word", "pos", F.col("child").alias("node"), "edits", found.alias("found"),
                      ((F.col("c") > 1) & (F.col("pos") < F.col("_len"))).alias("go")).where("go or found is not null")


def _one_edit(x: str, y: str):
    """Whether two different texts are one insertion, deletion or replacement
    apart: what follows their first difference is equal.  Linear in their
    length, which ``levenshtein`` is not."""
    differ = F.zip_with(F.split(x, ""), F.split(y, ""), lambda a, b: ~a.eqNullSafe(b))
    at = F.array_position(differ, True).cast("int")
    more = F.length(x) - F.length(y)
    size = F.greatest(F.length(x), F.length(y))
    after = (F.substring(x, at + F.when(more >= 0, 1).otherwise(0), size)
             == F.substring(y, at + F.when(more <= 0, 1).otherwise(0), size))
    return (F.abs(more) <= 1) & (at > 0) & after


def neighbours(words: DataFrame) -> DataFrame:
    """(u, v): both orders of each pair of near words; ``words`` (w, word) is
    a stable frame of distinct words and their numbers."""
    spark = words.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/trie-{uuid.uuid4().hex}"
    nodes = materialize(trie(words))
    frontier = words.select("w", "word", F.lit(0).alias("pos"), F.xxhash64(F.lit("")).alias("node"), F.lit(0).alias("edits"))
    depth = 0
    while True:
        here = nodes.where(F.col("depth") == depth).select("node", "kids")
        # The root and its children: at most 1 + 90 nodes of at most 90 children.
        _step(frontier, F.broadcast(here) if depth < 2 else here).write.parquet(f"{folder}/depth={depth}")
        level = spark.read.parquet(f"{folder}/depth={depth}")
        frontier = level.where("go").select("w", "word", "pos", "node", "edits")
        if frontier.isEmpty():
            break
        depth += 1
    found = spark.read.parquet(folder).where("found is not null").select(
        F.least("w", "found").alias("u"), F.greatest("w", "found").alias("v")).distinct()
    near = (found.join(words.select(F.col("w").alias("u"), F.col("word").alias("x")), "u")
            .join(words.select(F.col("w").alias("v"), F.col("word").alias("y")), "v")
            .where(_one_edit("x", "y")).select("u", "v"))
    near = materialize(near)
    return near.unionByName(near.select(F.col("v").alias("u"), F.col("u").alias("v")))


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n)."""
    words = materialize(words.select("word", "n").withColumn("w", F.monotonically_increasing_id()))
    near = neighbours(words.select("w", "word"))
    best = near.join(words.select(F.col("w").alias("v"), "word", "n"), "v").groupBy("u").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), "word", "v")).alias("b"))
    best = best.select(F.col("u").alias("w"), "n_near", (-F.col("b.m")).alias("form_n"), F.col("b.word").alias("form"),
                       F.col("b.v").alias("f"))
    rows = words.join(best, "w", "left").withColumn("ok", F.col("form_n") >= ratio * F.col("n"))
    rows = materialize(rows.select("w", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("form", "form_n", "f")]))
    ends = materialize(rows.where("f is not null").select("w", F.col("f").alias("root"), F.lit(True).alias("moved")))
    while not ends.where("moved").isEmpty():  # each round doubles the steps taken
        after = ends.select(F.col("w").alias("root"), F.col("root").alias("next"))
        ends = materialize(ends.select("w", "root").join(after, "root", "left").select(
            "w", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    ends = ends.select("w", "root").join(words.select(F.col("w").alias("root"), F.col("word").alias("to")), "root")
    return rows.join(ends.select("w", "to"), "w", "left").select(
        "word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")
