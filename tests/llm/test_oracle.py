"""Corpus queries against their SQL on the smallest data."""

import pytest
from sunledger.llm import registry

from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, name):
    con = connect(SF)
    assert difference(registry.QUERIES[name](spark, SF), con, registry.ORACLE[name]) is None
    con.close()
