"""The registered queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from entityforge.llm import registry

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_duckdb(spark, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    theirs = con.execute(registry.oracle_sql()[name])
    at = sorted(range(len(theirs.description)), key=lambda i: theirs.description[i][0])
    assert [theirs.description[i][0] for i in at] == columns
    assert sorted(tuple(str(r[i]) for i in at) for r in theirs.fetchall()) == sorted(tuple(map(str, r)) for r in df.select(columns).collect())
