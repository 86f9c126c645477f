"""Tree models as node arrays: equal to the models that they come from, also through JSON requests."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SF001
from volpanel.operators import hist_trees as ht
from volpanel.operators import portable, splits, trees
from volpanel.plans import evaluate, serve
from volpanel.plans import queries as q
from volpanel.schemas import TARGET, V1


@pytest.fixture(scope="module")
def panel(spark):
    return q.clean_panel(spark, SF001).cache()


@pytest.mark.parametrize("kind", ["forest", "boosted"])
@pytest.mark.parametrize("log_target", [False, True])
def test_spark_ml_models(spark, panel, kind, log_target):
    estimator = trees.forest(7, 4) if kind == "forest" else trees.boosted(6, 3)
    model = trees.fit_model(panel, V1, estimator, log_target)
    row = portable.from_spark_ml(model, V1, log_target)
    want = trees.assemble(portable.predict(panel, row, V1, model.getMaxDepth(), "mine"), V1)
    own = model.transform(want).withColumn("pred", F.exp("pred") if log_target else F.col("pred"))
    assert own.agg(F.max(F.abs(F.col("mine") / F.col("pred") - 1))).first()[0] < 1e-9


def test_grid_models(spark, panel):
    folded = splits.assign_folds(panel)
    models = {"f2": ht.Forest(5, 2), "f5": ht.Forest(5, 5), "b": ht.Boosted(6, 3)}
    grid, grown, names = ht.fit_grid(folded, {"v1": V1}, models, TARGET, "fold", [3], ["ticker", "date"])
    scored = ht.scored(grid, grown, names, ["ticker", "date"])
    for name, fit, depth in names:
        row = portable.from_grid(grid, grown, fit, 3, depth)
        mine = portable.predict(folded.where("fold = 3"), row, V1, depth, "mine").join(scored.where(F.col("candidate") == name).select("ticker", "date", "pred"), ["ticker", "date"])
        got = mine.agg(F.count("*"), F.max(F.abs(F.col("mine") - F.col("pred")))).first()
        assert got[0] == folded.where("fold = 3").count() and got[1] < 1e-9


def test_json_round_trip_and_requests(spark, panel):
    model = trees.fit_model(panel, V1, trees.forest(4, 3))
    path = tempfile.mkdtemp(prefix="volpanel-trees-", dir="/tmp") + "/model"
    serve.export_linear(portable.from_spark_ml(model, V1), path)
    row = serve.read_trees(spark, path)
    assert row.first()["features"] == V1 and len(row.first()["trees"]) == 4
    req = [json.dumps(dict(zip(V1, (0.01, 0.015, 0.014, 0.013)))), json.dumps({"ret": 1}), "{", json.dumps(dict.fromkeys(V1, "x"))]
    out = {r.request: r for r in serve.score_requests(spark.createDataFrame([(x,) for x in req], "request string"), row).collect()}
    assert [out[r].statusCode for r in req] == [200, 400, 400, 400]
    vector = trees.assemble(spark.createDataFrame([(0.01, 0.015, 0.014, 0.013, 0.0)], [*V1, TARGET]), V1)
    assert out[req[0]].pred_daily_vol == pytest.approx(model.transform(vector).first()["pred"], abs=1e-6)


def test_the_chosen_model_is_shipped(spark, panel, monkeypatch):
    for winner, tree in (("Random forest", True), ("Linear regression", False), ("GARCH(1,1)", False)):
        monkeypatch.setattr(evaluate, "benchmark_split", lambda *_, w=winner: spark.createDataFrame([(w, 0.1), ("Naive baseline (vol_5)", 0.2)], "model string, RMSE double"))
        monkeypatch.setattr(trees, "forest", lambda *_: trees.RandomForestRegressor(featuresCol=trees.VEC, labelCol="_y", predictionCol="pred", numTrees=3, maxDepth=2, seed=0))
        choice, row = evaluate.ship_chosen(panel)
        assert choice.first()["best"] == winner and ("trees" in row.columns) == tree
        answers = serve.score_requests(serve.requests_from_features(panel.limit(20), V1), row)
        assert answers.where("statusCode = 200").count() == 20
