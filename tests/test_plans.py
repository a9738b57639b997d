"""Physical-plan properties of headline queries (what `.explain` showed)."""

import pytest

from eventweave.plans.base import REGISTRY

from tests.conftest import SF001


def plan(spark, name):
    df = REGISTRY[name].build(spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


def test_span_match_is_an_equi_join_on_place_and_bucket(spark):
    p = plan(spark, "match_spans")
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p
    assert "__bucket" in p


def test_search_pushes_type_filter_and_prunes_columns(spark):
    df = REGISTRY["event_search"].build(spark, SF001)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
    orders_schemas = [line for line in text.splitlines() if "ReadSchema" in line and "o_orderpriority" in line]
    assert orders_schemas and all("o_totalprice" not in s for s in orders_schemas)


@pytest.mark.parametrize(
    "name",
    ["event_search", "match_days_state", "impute_end", "rewrite_rules", "parse_locations", "gazetteer_match",
     "crosstab_pct", "apply_patches", "fill_updown", "collapse_days", "impact_pivot_killed", "exposure"],
)
def test_no_python_in_the_plan(spark, name):
    p = plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, (name, node)
