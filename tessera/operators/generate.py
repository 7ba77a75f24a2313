"""Deterministic random columns.

Values are stateless functions of (seed, row key): a task that is retried or
a partition that is recomputed yields the same numbers, which a stateful
generator carried through the data (the reference's ``RandomState``) cannot
promise on a cluster.  They differ from Java's generator by design.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def digest_bits(seed: int, *keys, hex_digits: int = 13) -> Column:
    """The first hex digits of an MD5 digest of (seed, keys) as a bigint: a
    hash that every engine has.  Null keys count as empty."""
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substr(digest, F.lit(1), F.lit(hex_digits)), 16, 10).cast("bigint")


def uniform(seed: int, *keys) -> Column:
    """Uniform double in [0, 1) with 52 bits, from (seed, keys) (GEN-01)."""
    return digest_bits(seed, *keys) / F.lit(float(2 ** 52))


def signed_unit(seed: int, *keys) -> Column:
    """Uniform double in [-1, 1) (the reference's long -> double mapping)."""
    return uniform(seed, *keys) * 2 - 1


def gaussian(seed: int, *keys) -> Column:
    """Standard normal deviate by Box-Muller from two uniforms (GEN-02);
    ``u <= 0`` gives 0 as in the reference."""
    u = uniform(seed, *keys)
    v = uniform(seed + 1, *keys)
    return F.when(u <= 0, F.lit(0.0)).otherwise(F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v))


def spin(seed: int, total: Column, *keys) -> Column:
    """A draw in [0, total) for a weighted wheel lookup (GEN-03)."""
    return F.floor(uniform(seed, *keys) * total).cast("bigint")
