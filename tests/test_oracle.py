"""Every driver query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from compare import TABLES, digest
from daylake.plans import oracle, oracle_versions, queries, queries_versions
from tests.conftest import SF_SMALL

QUERIES = {**queries.QUERIES, **queries_versions.QUERIES}
ORACLE = {**oracle.ORACLE, **oracle_versions.ORACLE}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]
