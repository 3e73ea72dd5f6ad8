"""Registered queries against their DuckDB SQL at sf0.001."""

import duckdb
import pytest

from tradelake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(queries.ORACLE_SQL[name])
    want = [dict(zip([d[0] for d in rel.description], r)) for r in rel.fetchall()]
    got = [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]
    assert set(want[0]) == set(got[0])

    def in_order(rows):
        return sorted(str(sorted(r.items())) for r in rows)
    assert in_order(got) == in_order(want)
