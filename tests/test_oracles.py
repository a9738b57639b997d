"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver checks sf0.01 the same way)."""

import pytest

from eventweave.plans.base import REGISTRY

from tests.conftest import SF001
from tests.oracle_check import compare, duck

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    info = compare(spark, con, SF001, name, q.build, q.sql)
    assert info["ok"], info
