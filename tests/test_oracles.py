"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from scorebook.plans.queries import oracle_sql, queries
from tools.oracle_check import TABLES, key, norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF)
    rel = con.sql(SQL[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    si = [sdf.columns.index(c) for c in order]
    di = [rel.columns.index(c) for c in order]
    a = sorted((tuple(norm(r[i]) for i in si) for r in sdf.collect()), key=key)
    b = sorted((tuple(norm(r[i]) for i in di) for r in rel.fetchall()), key=key)
    assert len(a) == len(b)
    assert a == b
