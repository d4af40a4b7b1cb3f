"""Every registered query of the engine against its oracle."""

import os

import pytest

import oracle
from claimloom import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    frame = catalog.queries()[name](spark, SF)
    if name in catalog.oracle_sql():
        oracle.same(frame, con, catalog.oracle_sql()[name])
    else:
        assert frame.count() > 0
