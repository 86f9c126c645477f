"""Physical-plan properties of the main jobs."""

import pytest

from helpers import SF001
from volpanel.plans import queries as q

JOBS = ["features_v3_calendar", "features_v3_panel", "walk_forward_predictions", "score_requests", "forecast_latest", "garch_grid", "split_three_profile"]


@pytest.mark.parametrize("name", JOBS)
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = q.REGISTRY[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns_and_keeps_all_rows(spark):
    plan = q.REGISTRY["features_clean"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity" not in plan  # no row of the source is filtered away
    for unused in ("l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in plan


@pytest.mark.parametrize("name", ["final_model", "split_two_best", "split_two_metrics", "split_log_metrics", "garch_grid", "garch_forecast", "garch_split_coverage", "market_misses", "forecast_ranked"])
def test_panel_is_built_once(spark, name):
    """The result reads stored rows: the panel used to be built again for every part that reads it."""
    assert not any("lineitem" in f for f in q.REGISTRY[name](spark, SF001).inputFiles())
