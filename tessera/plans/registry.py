"""Query registry: each registered plan pairs a Spark builder with its SQL oracle.

A plan is ``fn(spark, sf_dir) -> DataFrame``.  The oracle is ANSI SQL over the
driver tables (as views) that computes the same rows and column names; it is
``None`` where the operator is not expressible in SQL (models, hashes, Python
state), in which case only row counts are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

PlanFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    name: str
    ids: tuple[str, ...]
    fn: PlanFn
    sql: str | None
    headline: bool = False


_PLANS: dict[str, Plan] = {}


def plan(name: str, ids: str, sql: str | None = None, headline: bool = False):
    """Register ``fn`` under ``name``; ``ids`` lists the SURVEY §2 ids it covers."""

    def deco(fn: PlanFn) -> PlanFn:
        if name in _PLANS:
            raise ValueError(f"duplicate plan {name}")
        _PLANS[name] = Plan(name, tuple(ids.split()), fn, sql, headline)
        return fn

    return deco


def all_plans() -> dict[str, Plan]:
    # Importing the family modules fills the registry.
    from tessera.plans import (  # noqa: F401
        aggregates, cleaning, graph, io_plans, ml, ordered, relational, streaming_plans, text,
    )
    return dict(_PLANS)
