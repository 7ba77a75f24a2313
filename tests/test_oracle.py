"""Every registered query against its SQL oracle (DuckDB) on the smallest
driver tables: same columns, row count and values."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tessera.plans.registry import all_plans
from tessera.sources.tables import TABLES

SQL = E.oracle_sql()
SLOW = {"order_status_forest", "order_status_forest_auc", "toxic_text_predictions", "embedding_mlp_precision"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if v is not None and hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return str(v)


def canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(df.columns, srows) == canon(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(all_plans()) - set(SQL) - SLOW))
def test_query_without_oracle_runs(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 0
