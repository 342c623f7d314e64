"""Every registered query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload.oracle import ORACLES
from workload.queries import QUERIES
from tools.compare import SAME_TYPE, canonical, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    types = {c[0]: str(c[1]) for c in result.description}
    assert {n: SAME_TYPE.get(t, t) for n, t in types.items()} == dict(df.dtypes)
    rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert rows == canonical(list(types), result.fetchall())


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 145
