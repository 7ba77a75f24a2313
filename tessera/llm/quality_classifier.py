"""Quality classifier (operator 3): histogram gradient-boosted trees over
document statistics.

Statistics are in-row Spark expressions over whole texts; only a dozen numbers
a document go to numpy, which walks the flattened trees for a whole Arrow
batch at once.  The trees are fitted on at most ``sample`` labelled documents,
those with the smallest hash of their id among the ones the caller allows.

Defined cases: null and empty texts are scored like any other (all statistics
0); repeated rows get equal scores; labels that are null are left out, of
conflicting ones the higher counts; without labelled documents of both kinds
every score is the smoothed share of label 1 (1/2 without any); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import gbt
from tessera.llm.common import hash_sample
from tessera.llm.quality_rules import add_statistics, measures

SAMPLE = 20_000


def features(docs: DataFrame, text_col: str, prefix: str = "__f_") -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with the statistics, and the features made of them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = add_statistics(docs, text_col, prefix).withColumns({
        prefix + "chars": F.length(text), prefix + "digits": F.regexp_count(text, F.lit("[0-9]")),
        prefix + "stops": F.regexp_count(text, F.lit("[.,;:]")), prefix + "marks": F.regexp_count(text, F.lit("[!?]"))})

    def a_char(n):
        return F.coalesce(F.col(prefix + n) / F.when(F.col(prefix + "chars") > 0, F.col(prefix + "chars")), F.lit(0.0))

    more = {"words": F.log1p(F.col(prefix + "n_words")), "lines": F.log1p(F.col(prefix + "n_lines")),
            "digits": a_char("digits"), "stops": a_char("stops"), "marks": a_char("marks")}
    return d, measures(prefix) | more


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, **options) -> gbt.Trees:
    """Trees from at most ``sample`` labelled documents; ``allowed`` is a
    condition on the label rows."""
    import numpy as np

    some = labels if allowed is None else labels.where(allowed)
    some = (some.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y"))
            .where("__id is not null and __y is not null").groupBy("__id").agg(F.max("__y").alias("__y")))
    some = hash_sample(some.withColumn("__h", F.xxhash64("__id")), "__h", sample).drop("__h")
    # At most ``sample`` rows of an id and a label.
    text = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(F.broadcast(some), "__id")
    d, f = features(text, "__t")
    row = F.struct(F.col("__y").alias("y"), *[c.cast("double").alias(n) for n, c in f.items()])
    got = d.groupBy("__id").agg(F.min(row).alias("r")).select("__id", "r.*").collect()
    got.sort(key=lambda r: md5(str(r["__id"]).encode()).digest())
    x = np.array([[r[n] for n in f] for r in got], float).reshape(len(got), len(f))
    return gbt.fit(x, np.array([float(r["y"] == 1) for r in got]), **options)


def score(docs: DataFrame, model: gbt.Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score): the probability of label 1 for each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    d, f = features(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), "_t")
    names = list(f)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(held.value.score(x))], names=["_id", "score"])

    rows = d.select("_id", *[c.cast("double").alias(n) for n, c in f.items()])
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)
