"""Every registered query against its SQL counterpart on the smallest test tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from marketide.plans.oracles import oracles
from marketide.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

ORACLES = oracles()

# Fitted models and what is built on them; tests/test_model.py checks them.
WITHOUT_SQL = {
    "gbt_ensemble_metrics", "gbt_errors", "gbt_importance", "permutation_importance",
    "scaled_pipeline_r2", "cv_search", "recursive_forecast", "regional_forecast",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()[:10]
    return value


def table(columns, data):
    """Rows with columns in name order, sorted, as plain values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=repr)


def test_every_query_has_sql_but_the_models():
    assert set(REGISTRY) - set(ORACLES) == WITHOUT_SQL
    assert not set(ORACLES) - set(REGISTRY)
    assert entry_point.queries().items() >= REGISTRY.items()
    assert entry_point.oracle_sql().items() >= ORACLES.items()
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = REGISTRY[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    relation = duck.sql(ORACLES[name])
    expected = table(relation.columns, relation.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) > 0
    assert got[1] == expected[1]


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
