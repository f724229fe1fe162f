"""Every registered query against its DuckDB oracle on the smallest test data."""

import pytest

from hearth.plans.compare import compare, duck
from hearth.plans.registry import REGISTRY

from conftest import SMALL_SF


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, key):
    entry = REGISTRY[key]
    assert entry.sql is not None, "every registered query has an oracle"
    result = compare(spark, con, key, entry, SMALL_SF)
    assert result["ok"], result


def test_entry_contract(spark):
    import __spark_entry__ as E

    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() > 0
