"""Every query against its SQL twin on the smallest tables; the forced second plan has tests of its own."""

import pytest

import __spark_entry__ as entry
from oracle import connect, difference

NAMES = [n for n in entry.queries() if not n.endswith("_split")]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, con, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert list(got.columns)
    else:
        assert difference(got, con.execute(sql).df()) is None


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
