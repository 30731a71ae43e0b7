"""Every registered query against its DuckDB oracle SQL (HEARTH_TEST_SF, default sf0.001)."""

import pytest

from hearth.bindings import load_all
from tests.conftest import SMALL_SF
from tests.oracle import duck, compare

REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    b = REG[name]
    df = b.fn(spark, SMALL_SF)
    if b.sql is None:
        assert df.count() >= 0
        return
    r = compare(df, con, b.sql)
    assert r["ok"], r
