"""Physical-plan properties the scale design relies on."""

import pytest

from hearth.plans.graph import ModelGraph
from hearth.plans.registry import MODEL_COLUMNS

from conftest import SMALL_SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def graph(spark):
    return ModelGraph(spark, SMALL_SF)


def test_latest_per_key_limits_before_the_shuffle(graph):
    p = plan(graph.dim_listings)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_flagship_scans_only_needed_columns_and_aggregates_partially(graph):
    p = plan(graph.fct_rent_trends)
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p
    assert "partial_max" in p and "partial_count" in p
    assert "sha2" not in p  # the content hash is pruned: nothing downstream reads it


@pytest.mark.parametrize("name", sorted(MODEL_COLUMNS))
def test_models_have_no_cartesian_product(graph, name):
    p = plan(getattr(graph, name))
    assert "CartesianProduct" not in p


def test_presence_filter_reaches_the_scan(graph):
    p = plan(graph.stg_permits)
    assert "PushedFilters: [IsNotNull(l_orderkey)" in p
