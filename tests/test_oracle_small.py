"""Every registered query vs its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

from helpers import SF_SMALL
from tradelake.functions.measures import MEASURES
from tradelake.plans.specs import OUTPUT_TABLES
from tradelake.sources.driver import DRIVER_TABLES

import __spark_entry__ as E

OWN = [*OUTPUT_TABLES, *MEASURES, *[f"json_{t}" for t in E.JSON_TABLES], "visit_window", "order_rejects"]
QUERIES = {k: q for k, q in E.queries().items() if k in OWN}
SQL = {k: q for k, q in E.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL) == set(OWN) and len(QUERIES) == 87


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["filial_code", "n_orders", "total_sales", "avg_sales"]
    assert df.count() > 0
