"""Every registered query against its SQL on the given tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, differences

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, sf_dir, con):
    df = queries()[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) is None
    else:
        assert df.count() >= 0


def test_entry(spark):
    assert entry(spark).count() > 0
