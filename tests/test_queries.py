"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from marketlake.registry import ORACLES, QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, SF).count() > 0
        return
    problem = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert problem in (None, "no rows on either side"), problem


def test_entry_points(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
