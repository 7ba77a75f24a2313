"""Mixing sources to target weights (operator 9) by Poisson replication.

A source's target share of the mix divided by what it holds gives its mean
repetition rate.  Each document draws how often it is repeated from a Poisson
distribution of that mean, by inverting its distribution function at a number
hashed from (seed, id): the draw does not depend on partitions, order or
retries, needs no shuffle, and a hot source is just many independent rows.
Copies are exploded and put into global random order by a second hash.

Sizes of at most ``len(weights) + 1`` groups reach the driver: the named
sources and all others together (``"*"``).

Defined cases: null or unnamed sources belong to ``"*"`` (weight 0 unless
given); null text has size 0 and a group of size 0 is not drawn; rows with the
same id draw alike; a null id is hashed as an empty string; an empty table
gives an empty result; other columns are kept, also those called like the added ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import exp, fsum, lgamma, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh

OTHER = "*"


def thresholds(rate: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, up to where no 52-bit
    number lies above."""
    out, terms, k = [], [], 0
    while rate > 0 and (not out or out[-1] < 1 - 2.0 ** -52) and k < rate + 40 * (1 + rate ** 0.5):
        terms.append(exp(k * log(rate) - rate - lgamma(k + 1)))
        out.append(min(1.0, fsum(terms)))
        k += 1
    return out


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substr(digest, F.lit(1), F.lit(13)), 16, 10).cast("long") / F.lit(float(2 ** 52))


def repetition_rates(docs: DataFrame, weights: Mapping[str, float], total: float | None = None,
                     source_col: str = "source", text_col: str = "text") -> dict[str, float]:
    """Mean repetitions of each named source and of ``"*"``.  ``total`` is the
    size of the mix in UTF-8 bytes (None: as large as ``docs``)."""
    sizes = {r["g"]: r["size"] or 0 for r in docs.select(
        group_of(weights, source_col).alias("g"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n"))
        .groupBy("g").agg(F.sum("n").alias("size")).collect()}
    whole = sum(sizes.values()) if total is None else total
    weight = fsum(weights.values())
    return {g: whole * w / weight / sizes[g] if sizes.get(g) else 0.0 for g, w in weights.items()}


def group_of(weights: Mapping[str, float], source_col: str) -> Column:
    named = [s for s in weights if s != OTHER]
    return F.when(F.col(source_col).isin(named), F.col(source_col)).otherwise(F.lit(OTHER))


def replicate(docs: DataFrame, rates: Mapping[str, float], seed: str = "mix", id_col: str = "doc_id",
              source_col: str = "source", copy: str = "copy", key: str = "shuffle_key") -> DataFrame:
    """``docs`` with each row repeated by its draw, the number of the copy
    (from 0) and the key of the global order, under ``copy`` and ``key``, or
    those names with underscores behind where ``docs`` has such columns."""
    copy = fresh(copy, docs)
    key = fresh(key, docs)
    u = uniform(seed, F.col(id_col))
    draws = F.lit(0)
    table = F.create_map(*[x for g, r in rates.items() for x in (
        F.lit(g), F.array(*[F.lit(t) for t in thresholds(r)]).cast("array<double>"))]) if rates else None
    if table is not None:
        of = F.coalesce(F.element_at(table, group_of(rates, source_col)), F.array().cast("array<double>"))
        draws = F.size(F.filter(of, lambda t: t <= u))
    rows = docs.withColumn(copy, F.explode(F.when(draws > 0, F.sequence(F.lit(0), draws - 1))))
    digest = F.md5(F.concat_ws(":", F.lit(seed + "/order"), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                               F.col(copy).cast("string")))
    return rows.withColumn(key, digest)


def mix(docs: DataFrame, weights: Mapping[str, float], total: float | None = None, seed: str = "mix",
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix in global random order, with ``copy`` and ``shuffle_key``."""
    rates = repetition_rates(docs, weights, total, source_col, text_col)
    mixed = replicate(docs, rates, seed, id_col, source_col)
    return mixed.orderBy(mixed.columns[-1])
