"""Linked page chains (STR-01..05).

A page chain is a linked list: each payload names the next one.  Following
it pointer by pointer takes as many rounds as the chain is long.  Here the
order is recovered by *pointer jumping* (list ranking): every round each
node adds its successor's distance and jumps to its successor's successor,
so a chain of length n is ranked in ceil(log2 n) rounds of joins, all
nodes and all chains at once.  Each round is checkpointed to the shared
checkpoint folder.

Landed pages (one JSON file each, ``{"items": [...], "next": token}``) are
read by Spark's own reader and put in chain order the same way.
"""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared checkpoint folder."""
    return materialize(df)


def chain_positions(nodes: DataFrame, node: str = "id", nxt: str = "next") -> DataFrame:
    """(id, tail, pos) for every node of every chain given as (id, next):
    ``pos`` counts from the head (0), ``tail`` identifies the chain.  A next
    node that is not there ends the chain.  Nodes on a cycle, or leading into
    one, have no tail: both are null."""
    known = nodes.select(F.col(node).alias("_n"))
    cur = _cut(nodes.select(F.col(node).alias("id"), F.col(nxt).alias("_s")).join(known, F.col("_s") == F.col("_n"), "left")
               .select("id", F.col("_n").alias("succ"), F.when(F.col("_n").isNull(), 0).otherwise(1).cast("bigint").alias("dist"),
                       F.when(F.col("_n").isNull(), F.col("id")).alias("tail")))
    # A chain of n nodes is ranked in log2(n) rounds; what still has a
    # successor after that is on a cycle.
    for _ in range(cur.count().bit_length() + 1):
        if cur.where(F.col("succ").isNotNull()).isEmpty():
            break
        s = cur.select(F.col("id").alias("succ"), F.col("succ").alias("succ2"), F.col("dist").alias("dist2"),
                       F.col("tail").alias("tail2"))
        j = cur.join(s, "succ", "left")
        cur = _cut(j.select(
            "id", F.when(F.col("succ").isNull(), F.lit(None)).otherwise(F.col("succ2")).alias("succ"),
            (F.col("dist") + F.when(F.col("succ").isNull(), F.lit(0)).otherwise(F.coalesce("dist2", F.lit(0)))).alias("dist"),
            F.coalesce(F.col("tail"), F.when(F.col("succ2").isNull(), F.col("tail2"))).alias("tail")))
    length = cur.where("tail is not null").groupBy(F.col("tail").alias("_t")).agg(F.max("dist").alias("_len"))
    return cur.join(length, F.col("tail") == F.col("_t"), "left").select(
        "id", "tail", (F.col("_len") - F.col("dist")).alias("pos"))


def read_page_chain(spark, folder: str, items: str = "string") -> DataFrame:
    """(page, page_pos, item_pos, item) of landed page files ``<token>.json``
    in chain order: pages by their place in the chain, items within a page.
    Pages of several chains come with the chain's ``tail``."""
    pages = spark.read.schema(f"items array<{items}>, next string").option("multiLine", True).json(folder).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("page"), "items", "next")
    pages = _cut(pages)
    placed = chain_positions(pages, "page", "next").withColumnRenamed("id", "page").withColumnRenamed("pos", "page_pos")
    return pages.join(placed, "page").select(
        "tail", "page", "page_pos", F.posexplode("items").alias("item_pos", "item"))


def merge_chains(chains: list[DataFrame], payload: str, process: Callable[[str], object], result: str,
                 name: str = "result") -> DataFrame:
    """Several chains (frames of the same columns) as one frame, with the
    caller's function applied to each payload (null payloads give null)."""
    out = chains[0]
    for c in chains[1:]:
        out = out.unionByName(c)

    def each(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else process(v)).astype(object)

    return out.withColumn(name, F.pandas_udf(each, result)(F.col(payload)))
