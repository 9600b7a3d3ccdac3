"""Registered queries against their SQL twins at the smallest scale; the driver repeats this at sf0.01."""

import pytest

from tests.oracle import compare, duck
from tokenloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert compare(got, con.execute(ORACLES[name]).df()) == ""
    else:
        assert len(got) > 0
