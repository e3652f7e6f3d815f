"""Every training-data query that has oracle SQL against DuckDB on the smallest driver tables."""

from __future__ import annotations

import duckdb
import pytest

from arqueo.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = con.sql(queries.ORACLE[name])
    assert sorted(want.columns) == columns
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, want.select(*columns).fetchall()))


def test_one_query_per_operator():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
