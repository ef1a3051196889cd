"""Every registered query against its SQL on the smallest data."""

import __spark_entry__ as entry_module
import pytest

from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
ORACLE = {k: v for k, v in entry_module.oracle_sql().items() if k in entry_module.registry.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = connect(SF)
    yield c
    c.close()


def test_every_query_has_expected_sql():
    assert set(entry_module.registry.QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    assert difference(df, con, ORACLE[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
