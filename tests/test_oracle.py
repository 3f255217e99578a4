"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF0001
from mortar.plans.queries import ORACLE, QUERIES

TABLES = ["orders", "events"]
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF0001, t)}.parquet')")
    return con


# An iterative fit: tests/test_hazard.py holds it against NumPy.
NO_SQL = {"hazard_fit", "hazard_calibration"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    duck_types = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {c.lower(): SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    assert spark_types == duck_types
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "F3Q_POST_MAXDLQ_12" in df.columns
