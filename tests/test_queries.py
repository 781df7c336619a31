"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(name, spark, sf_dir, duck):
    df = entry.queries()[name](spark, sf_dir)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-2:] == ["label", "source"]
    assert df.groupBy("source").count().count() == 3
