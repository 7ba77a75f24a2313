"""Token counts (operator 2).

Pieces are counted once for each distinct pre-token of the corpus and joined
to per-document pre-token frequencies; ids are never materialised.

1. *Vocabulary.*  Every task keeps the distinct pre-tokens of its documents
   with the number of documents that use them; a shuffle by pre-token sums
   them, and each distinct pre-token is encoded once, by the tokenizer, to
   its number of pieces.
2. *Frequencies.*  Each document becomes (pre-token, frequency) rows.  The
   most frequent pre-tokens (at most ``HEAD`` keys of at most ``MAX_KEY``
   characters: a fixed size at any corpus size) are a broadcast dictionary, and what they contribute is summed on the spot.  The rest is
   joined to the vocabulary by a shuffle.  A pre-token outside the head
   makes up little more than 1/HEAD of all uses, so no join key
   of that shuffle can be hot.
3. Sums per document.

A pre-token is text cut where the tokenizer's own pattern always cuts (see
:mod:`tessera.llm.chunks`); those longer than ``MAX_KEY``
characters travel as a SHA-256 digest and are counted where they are first
read.

Defined cases: null text counts as empty (0 bytes, 0 tokens); repeated rows
give repeated results; a null id stays null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import chunks as C
from tessera.llm.common import materialize, row_hash, text_or_empty

HEAD = 1 << 18
STEPS = 8  # classes of use counts for each doubling
MAX_KEY = 64
FLUSH = 200_000  # distinct pre-tokens a task holds before it hands them on


def _key(chunk: str) -> str:
    return chunk if len(chunk) <= MAX_KEY else "\x00" + sha256(chunk.encode("utf-8", "surrogatepass")).hexdigest()


def _vocabulary(path: str):
    def run(batches):
        import pyarrow as pa

        held: Counter = Counter()  # chunk -> documents of this task

        def flush():
            uses: Counter = Counter()
            for chunk, n in held.items():
                for p in C.parts(chunk):
                    uses[p] += n
            uses.pop("", None)
            long = {p: _key(p) for p in uses if len(p) > MAX_KEY}
            size = dict(zip(long, (len(i) for i in C.encode_all(path, list(long), plain=True))))
            held.clear()
            return pa.RecordBatch.from_pydict({
                "key": pa.array([long.get(p, p) for p in uses], pa.string()),
                "uses": pa.array(list(uses.values()), pa.int64()),
                "n": pa.array([size.get(p) for p in uses], pa.int64())})

        for batch in batches:
            for part in C.slices(batch):
                for text in part.column(0).to_pylist():
                    held.update(set(C.cut(text)))
                if len(held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


def _pieces(path: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys, n = batch.column("key").to_pylist(), batch.column("n").to_pylist()
            todo = [k for k, x in zip(keys, n) if x is None]
            count = dict(zip(todo, (len(ids) for ids in C.encode_all(path, todo, plain=True))))
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "uses": batch.column("uses"),
                "n": pa.array([count[k] if x is None else x for k, x in zip(keys, n)], pa.int64())})

    return run


def vocabulary(texts: DataFrame, path: str) -> DataFrame:
    """(key, uses, n): the distinct pre-tokens of column ``text``, how many
    (row, chunk) pairs hold each, and its number of pieces."""
    return (texts.mapInArrow(_vocabulary(path), "key string, uses long, n long")
            .groupBy("key").agg(F.sum("uses").alias("uses"), F.max("n").alias("n"))
            .mapInArrow(_pieces(path), "key string, uses long, n long"))


def _frequencies(head):
    def run(batches):
        import pyarrow as pa

        known = head.value
        memo: dict[str, int | None] = {}  # chunk -> its pieces, None if the join must tell

        def pieces(chunk):
            n = [known.get(p) for p in C.parts(chunk)]
            return None if None in n else sum(n)

        for batch in batches:
            if len(memo) > C.MAX_CACHE:
                memo.clear()
            for part in C.slices(batch):
                ids, hashes, sizes, keys, freqs, sums = [], [], [], [], [], []
                for rid, h, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    total, rest = 0, Counter()
                    for chunk, f in Counter(C.cut(text)).items():
                        if chunk in memo:
                            n = memo[chunk]
                        else:
                            n = memo[chunk] = pieces(chunk)
                        if n is not None:
                            total += n * f
                        else:
                            for p in C.parts(chunk):
                                if p in known:
                                    total += known[p] * f
                                else:
                                    rest[_key(p)] += f
                    m = len(rest)
                    ids += [rid] * (1 + m)
                    hashes += [h] * (1 + m)
                    sizes += [len(text.encode())] + [None] * m
                    keys += [None, *rest]
                    freqs += [None, *rest.values()]
                    sums += [total] + [None] * m
                yield pa.RecordBatch.from_pydict({
                    "_id": pa.array(ids, part.column(0).type), "_h": pa.array(hashes, pa.int64()),
                    "bytes": pa.array(sizes, pa.int64()), "key": pa.array(keys, pa.string()),
                    "f": pa.array(freqs, pa.int64()), "s": pa.array(sums, pa.int64())})

    return run


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer_path: str | None = None, limit: int = 1024) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) for each row of ``docs``."""
    path = tokenizer_path or C.default_path()
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(text_col)
    vocab = materialize(vocabulary(docs.select(text.alias("text")), path))
    # The head is the highest classes of use counts that hold at most HEAD
    # pre-tokens together: a few hundred counts, then at most HEAD rows with
    # keys of at most MAX_KEY characters, reach the driver.
    level = F.floor(F.log2("uses") * STEPS)
    cut, total = 1 << 30, 0
    for r in vocab.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        total += r["count"]
        if total > HEAD:
            break
        cut = r["level"]
    top = vocab.where(level >= cut).select("key", "n").collect()
    head = spark.sparkContext.broadcast({r["key"]: r["n"] for r in top if not r["key"].startswith("\x00")} | {"": 0})
    rows = (docs.select(F.col(id_col).alias("_id"), text.alias("text"))
            .select("_id", row_hash("_id", "text").alias("_h"), "text")
            .mapInArrow(_frequencies(head), f"_id {kind}, _h long, bytes long, key string, f long, s long"))
    # One row of a document has no key: it holds the sum over the head.
    tail = rows.where("key is not null").select("_id", "_h", "key", "f")
    own = rows.where("key is null").select("_id", "_h", "bytes", F.col("s"), F.lit(1).alias("rows"))
    joined = tail.join(vocab.select("key", "n"), "key").select(
        "_id", "_h", F.lit(None).cast("long").alias("bytes"), (F.col("f") * F.col("n")).alias("s"),
        F.lit(0).alias("rows"))
    # Equal rows are one group: each adds the same sum, so the sum over the
    # group divides exactly by the number of rows.
    out = (own.unionByName(joined).groupBy("_id", "_h")
           .agg(F.max("bytes").alias("n_bytes"), F.sum("s").alias("s"), F.sum("rows").alias("rows"))
           .withColumn("n_tokens", F.expr("s div rows"))
           .withColumn("_r", F.explode(F.expr("sequence(1, cast(rows as int))"))))
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
