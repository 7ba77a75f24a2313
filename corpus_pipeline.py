"""Corpus pipeline: documents through five of the training-data operators.

Quality rules, SimHash near-dedup, secret scans, mixing sources to target
weights, best-fit packing.  Each stage reads all that the one before wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import mixing, packing, quality_rules, secret_scan, simhash
from tessera.llm.common import table
from tessera.llm.queries import WEIGHTS
from tessera.session import checkpoint_dir

#: No SQL: learned rules, XXH64 votes and best-fit packing are not SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a learned rule reject go."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, rules)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.deduplicate(docs, shingle=4, max_bits=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets found in the texts are replaced by a mark."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to the target weights and shuffled globally."""
    return mixing.mix(docs, WEIGHTS).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in the sequences."""
    return packing.pack(docs, capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("mixing", mix),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and
    read again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
