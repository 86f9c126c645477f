"""Single forests from the histogram learner: benchmark and shipping."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from volpanel.operators import hist_trees, portable, trees
from volpanel.plans import evaluate, queries as q
from volpanel.schemas import TARGET, V1
from volpanel.session import write_once

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def panel(spark):
    return write_once(q.clean_panel(spark, SF001).limit(1500), "wide")


def test_scores_ship_alike_and_rows_without_a_feature_stay(spark, panel):
    model = trees.fit_model(panel, V1, trees.wide_forest(12, 4))
    assert len(model.arrays) == 12
    holed = panel.withColumn("vol_5", F.when(F.col("vol_5") > 0.02, F.col("vol_5")))
    got = model.transform(holed)
    assert got.count() == panel.count() and got.where("pred is null").count() == holed.where("vol_5 is null").count()
    row = portable.from_model(model, V1)
    both = portable.predict(model.transform(panel), row, V1, model.getMaxDepth(), "mine").agg(F.max(F.abs(F.col("mine") - F.col("pred"))), F.count("mine")).first()
    assert both[0] < 1e-12 and both[1] == panel.count()


def test_as_good_as_the_other_learner(panel):
    cut = panel.agg(F.percentile_approx("ret", 0.8)).first()[0]
    train, test = panel.where(F.col("ret") < cut), panel.where(F.col("ret") >= cut)
    for log_target in (False, True):
        own, other = (evaluate.metrics.metrics(trees.fit_predict(train, test, V1, e, log_target), TARGET, "pred").first()["RMSE"] for e in (trees.wide_forest(40, 4), trees.forest(40, 4)))
        assert own == pytest.approx(other, rel=0.05)


def test_benchmark_fits_no_spark_ml_forest(panel, monkeypatch):
    """Spark ML holds two numbers per row and tree: 200 trees of 26 million rows did not end in time."""
    monkeypatch.setattr(trees, "forest", lambda *_: pytest.fail("a Spark ML forest"))
    board = {r["model"]: r for r in evaluate.benchmark_split(panel).collect()}
    assert board["Random forest"]["rows"] == board["Naive baseline (vol_5)"]["rows"] > 0
    assert hist_trees.TASK_ROWS * hist_trees.FOREST_TIMES >= 26_000_000


def test_fewer_trees_a_task_when_cores_are_free(spark, panel):
    grid, _, _ = hist_trees.fit_grid(panel.withColumn("s", F.lit(0)), {"a": V1}, {"f": hist_trees.Forest(20, 2)}, TARGET, "s", [1], ["ticker", "date"])
    cores = spark.sparkContext.defaultParallelism
    assert len(grid.units(True)) == -(-20 // max(5, -(-20 // cores))) and sum(u[3] for u in grid.units(True)) == 20


def test_walks_reach_the_same_node_on_every_path(monkeypatch):
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 64, (3, 4000)).astype(np.uint8), rng.normal(size=4000)
    step = hist_trees.unit(4000, 4 * np.abs(y).max())
    made = []
    for few, paired in ((0, 0), (99, 99)):
        monkeypatch.setattr(hist_trees, "FEW_NODES", few)
        monkeypatch.setattr(hist_trees, "PAIRED_SLOTS", paired)
        tree, at = hist_trees.grown(hist_trees.Forest(1, 6), x, np.arange(4000, dtype=np.uint64), np.rint(y / step), 0, step, np.arange(3))
        node = np.zeros(4000, np.int64)
        for _ in range(6):
            f = tree.feature[node]
            node = np.where(f < 0, node, 2 * node + 1 + (x[np.maximum(f, 0), np.arange(4000)] > tree.bin[node]))
        assert (tree.walk(x, 6) == node).all() and (tree.place(6)[at] == node).all()
        made.append(tree)
    assert (made[0].feature == made[1].feature).all() and (made[0].value == made[1].value).all()


def test_selection_stores_its_panel_once(spark, panel, monkeypatch):
    """The panel was built for the cutoffs and again for the rows."""
    stored = []
    monkeypatch.setattr(evaluate, "write_once", lambda df, name="table": stored.append(name) or write_once(df, name))
    got = evaluate.select_on_validation(panel, {"v1": V1}, ["Linear"]).collect()
    assert stored == ["panel", "validation"] and len(got) == 4


def test_the_trees_are_walked_once_per_request(spark, panel):
    """They were walked once for every output that reads the answer, and copied into the rows on the way."""
    from volpanel.plans import serve

    row = write_once(portable.from_model(trees.fit_model(panel, V1, trees.wide_forest(3, 2)), V1), "model")
    out = serve.score_requests(serve.requests_from_features(panel, V1), row)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("sequence(1") == 1
