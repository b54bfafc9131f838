"""Queries against their SQL in DuckDB."""

import duckdb
import pytest

from gridlake.llm import queries, sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.QUERIES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.execute(sql.QUERIES[name])
    names = [c[0] for c in rel.description]
    want = sorted(map(str, rel.fetchall()))
    got = queries.queries()[name](spark, SF).select(names).collect()
    assert sorted(str(tuple(r)) for r in got) == want
