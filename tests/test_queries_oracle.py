"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from arqueo.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"ejercicio", "mes", "cta_cte", "diferencia"} <= set(df.columns)


def test_every_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert not missing, missing
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(catalog.ORACLE[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
