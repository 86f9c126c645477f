import numpy as np
from pyspark.sql import functions as F

from helpers import SF01
from volpanel.operators import linear, splits, trees
from volpanel.plans import evaluate
from volpanel.plans import queries as q
from volpanel.schemas import TARGET, V1


def test_fit_matches_lstsq(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(500, 4)) * [1.0, 0.5, 2.0, 0.1] + [0.0, 3.0, -1.0, 10.0]
    y = X @ [0.3, -0.2, 0.05, 1.5] + 0.7 + rng.normal(scale=0.1, size=500)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)], [*V1, TARGET])
    c = linear.fit(df, V1, TARGET).first()
    A = np.column_stack([X, np.ones(len(X))])
    ref = np.linalg.lstsq(A, y, rcond=None)[0]
    got = [c[f"b{i}"] for i in range(4)] + [c["intercept"]]
    assert np.allclose(got, ref, rtol=1e-9, atol=1e-9)


def test_expanding_equals_direct_fit(spark):
    folded = splits.assign_folds(q.clean_panel(spark, SF01))
    wf = {r["fold"]: r for r in linear.fit_walk_forward(folded, V1, TARGET).collect()}
    assert sorted(wf) == [1, 2, 3, 4]
    for k in (1, 3):
        direct = linear.fit(folded.where(F.col("fold") < k), V1, TARGET).first()
        for name in [f"b{i}" for i in range(4)] + ["intercept"]:
            assert abs(wf[k][name] - direct[name]) <= 1e-9 * (1 + abs(direct[name]))


def test_matches_spark_ml(spark):
    folded = splits.assign_folds(q.clean_panel(spark, SF01))
    train, test = folded.where("fold < 2"), folded.where("fold = 2")
    ours = evaluate.fit_predict_any(train, test, V1, "Linear").select("ticker", "date", F.col("pred").alias("a"))
    ml = trees.fit_predict(train, test, V1, trees.linear_ml()).select("ticker", "date", F.col("pred").alias("b"))
    diff = ours.join(ml, ["ticker", "date"]).agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("d"), F.count("*").alias("n")).first()
    assert diff["n"] == test.count()
    assert diff["d"] < 1e-6


def test_walk_forward_no_python_and_broadcast_coefficients(spark):
    folded = splits.assign_folds(q.clean_panel(spark, SF01))
    plan = evaluate.linear_walk_forward(folded)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_purged_walk_forward_equals_direct_fit_on_purged_rows(spark):
    from volpanel.operators import features as feat
    from volpanel.sources import panels

    f = feat.clean_v1(feat.add_features(panels.supplier_day(spark, SF01), target_end=True))
    folded = splits.assign_folds(f, purge_col="target_end")
    wf = {r["fold"]: r for r in linear.fit_walk_forward(folded, V1, TARGET, purge=True).collect()}
    plain = {r["fold"]: r for r in linear.fit_walk_forward(folded, V1, TARGET).collect()}
    edges = splits.fold_edges(f).first()
    for k in (1, 2, 4):
        train = folded.where((F.col("fold") < k) & (F.col("target_end") < F.lit(edges[f"e{k}"])))
        assert train.count() < folded.where(F.col("fold") < k).count()
        direct = linear.fit(train, V1, TARGET).first()
        for name in [f"b{i}" for i in range(4)] + ["intercept"]:
            assert abs(wf[k][name] - direct[name]) <= 1e-9 * (1 + abs(direct[name]))
        assert wf[k]["b0"] != plain[k]["b0"]
