"""Every registered query against its DuckDB oracle on the smallest tables:
row count, column names and the order-insensitive multiset of rows."""

import pytest

from aidspark import oracle, queries
from tests.conftest import SF_SMALL
from tools.compare import _rows, duck

QUERIES = queries.registry()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = df.collect(), df.columns
    rel = con.sql(ORACLE[name])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(scols, srows) == _rows(dcols, drows)
