"""The registered tree queries cover the whole grid of feature sets and models, here with a few trees each."""

import pytest

from helpers import SF001
from volpanel.operators import hist_trees as ht
from volpanel.plans import evaluate, queries
from volpanel.schemas import FEATURE_SETS


@pytest.fixture
def few(monkeypatch):
    small = {m: type(s)(4, s.depth) for m, s in evaluate.TREE_MODELS.items()}
    monkeypatch.setattr(evaluate, "TREE_MODELS", small)


def test_the_grid_is_whole():
    forest, boosted = evaluate.TREE_MODELS["RF depth=8"], evaluate.TREE_MODELS["GBT depth=5"]
    assert (forest.trees, forest.depth) == (300, 8) and evaluate.TREE_MODELS["RF depth=4"] == ht.Forest(300, 4)
    assert boosted == ht.Boosted(300, 5, 0.05, 0.8, 0.8) and evaluate.TREE_MODELS["GBT depth=3"] == ht.Boosted(300, 3, 0.05, 0.8, 0.8)
    assert queries.CANDIDATES == ["Linear", *evaluate.TREE_MODELS]


def test_walk_forward_boards(spark, few):
    forest = queries.REGISTRY["walk_forward_forest"](spark, SF001).collect()
    boosted = queries.REGISTRY["walk_forward_gbt"](spark, SF001).collect()
    assert {(r.features, r.model) for r in forest + boosted} == {(s, m) for s in FEATURE_SETS for m in evaluate.TREE_MODELS} and len(forest) == len(boosted) == 6
    assert all(r.mean_RMSE > 0 and r.std_RMSE >= 0 for r in forest + boosted)


def test_selection_refits_the_best(spark, few):
    got = queries.REGISTRY["select_on_validation"](spark, SF001).collect()
    val = [r for r in got if r.role == "val"]
    assert {(r.features, r.model) for r in val} == {(s, m) for s in FEATURE_SETS for m in queries.CANDIDATES} and len(val) == 15
    best = min(val, key=lambda r: (r.RMSE, r.features, r.model))
    test = [r for r in got if r.role == "test"]
    assert [r.model for r in test] == ["Naive baseline (vol_5)", f"Final model: {best.model}", "Linear v1 (shipped)"] and test[1].features == best.features
    sets = queries.REGISTRY["select_on_validation_v2"](spark, SF001)
    assert sets.where("role = 'val'").count() == 10
