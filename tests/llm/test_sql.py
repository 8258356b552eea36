"""Every query of this folder that has SQL, against DuckDB on the small tables."""
import collections

import duckdb
import pytest

from clickseg.llm import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


def test_sql_belongs_to_queries():
    assert set(catalog.all_sql()) <= set(catalog.all_queries())
    assert all(isinstance(x, str) for x in catalog.all_sql().values())


@pytest.mark.parametrize("name", sorted(catalog.all_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{SF}/{t}.parquet')")
    got, want = catalog.all_queries()[name](spark, SF), con.sql(catalog.all_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in got.columns]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(tuple(r[i] for i in at) for r in want.fetchall())
