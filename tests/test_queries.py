"""Every query against its check SQL on the smallest tables."""

import os

import pytest
from check_queries import compare, connect

from maskloom.plans.all_queries import oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        error, _ = compare(df, con, SQL[name])
        assert error is None, error
    else:
        assert df.count() > 0


def test_only_clustering_has_no_sql():
    assert set(QUERIES) - set(SQL) == {"kmeans_select_k"}
