"""Every registered query on the smallest tables, next to its SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_text_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[0] == "packet_id" and 0 < rows.count() <= 100
