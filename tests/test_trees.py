"""Tree learners: row counts, determinism under the seed, error bounds (not bit-comparable)."""

import math

from pyspark.sql import functions as F

from helpers import SF001
from volpanel.operators import splits, trees
from volpanel.plans import evaluate
from volpanel.plans import queries as q
from volpanel.schemas import TARGET, V1


def test_forest_walk_forward_deterministic_and_bounded(spark):
    folded = splits.assign_folds(q.clean_panel(spark, SF001))
    est = lambda: trees.forest(20, 4)
    a = trees.walk_forward(folded, V1, est).select("ticker", "date", F.col("pred").alias("a"))
    b = trees.walk_forward(folded, V1, est).select("ticker", "date", F.col("pred").alias("b"))
    j = a.join(b, ["ticker", "date"])
    assert j.count() == folded.where("fold >= 1").count()
    assert j.where(F.col("a") != F.col("b")).count() == 0
    m = evaluate.metrics.metrics(trees.walk_forward(folded, V1, est), TARGET, "pred").first()
    spread = folded.agg(F.stddev_pop(TARGET)).first()[0]
    assert math.isfinite(m["RMSE"]) and m["RMSE"] < 3 * spread


def test_benchmark_split_rows(spark):
    board = evaluate.benchmark_split(q.clean_panel(spark, SF001)).collect()
    assert [r["model"] for r in board] == ["Naive baseline (vol_5)", "Linear regression", "Random forest", "GARCH(1,1)"]
    assert len({r["rows"] for r in board[:3]}) == 1
    choice = evaluate.choose_model(evaluate.benchmark_split(q.clean_panel(spark, SF001))).first()
    assert choice["shipped"] in ("Linear regression", "Random forest")
