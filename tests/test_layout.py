"""Results that must not depend on partition layout, caches, plan reuse or session settings."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF001, day
from volpanel.functions.rows import require_date
from volpanel.operators import features, garch, linear, market, metrics, splits, trees
from volpanel.plans import queries as q
from volpanel.schemas import TARGET, V1
from volpanel.sources import models


@pytest.fixture
def no_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    yield
    spark.conf.set("spark.sql.exchange.reuse", "true")


def test_sequence_numbers_of_a_hot_key_without_cache_or_reuse(spark, no_reuse):
    df = spark.range(200_000).selectExpr("'hot' AS ticker", "date_add(DATE'1500-01-01', CAST(id % 100000 AS INT)) AS d", "id AS date")
    seq = features.sequence_numbers(df, "ticker", "date", n_parts=7)
    spark.catalog.clearCache()
    assert seq.where("seq <> date").count() == 0


def test_panel_fill_of_many_keys_without_reuse(spark, no_reuse):
    df = spark.range(60_000).selectExpr("lpad(CAST(id AS STRING), 8, '0') AS ticker", "DATE'2024-01-01' AS date", "CASE WHEN id % 5 = 0 THEN id END AS v")
    out = market.ffill_panel(df, ["v"], blocks=8)
    spark.catalog.clearCache()
    assert out.where("v <> CAST(ticker AS INT) - CAST(ticker AS INT) % 5 OR v IS NULL").count() == 0


def test_forest_does_not_depend_on_settings(spark):
    folded = splits.assign_folds(q.clean_panel(spark, SF001)).where("fold <= 1").cache()
    got = []
    for n in ("5", "13"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        scored = trees.fit_predict(folded.where("fold = 0"), folded.where("fold = 1"), V1, trees.forest(5, 4))
        got.append(metrics.metrics(scored, TARGET, "pred").first()["RMSE"])
        spark.conf.set("spark.sql.shuffle.partitions", old)
    folded.unpersist()
    assert got[0] == pytest.approx(got[1], rel=1e-12)


@pytest.mark.parametrize("kind", ["constant", "collinear", "far"])
def test_least_squares_always_has_a_model(spark, kind):
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 3))
    y = x @ [1.0, -2.0, 0.5] + 0.1 * r.normal(size=300)
    if kind == "constant":
        x[:, 1] = 7.3
    elif kind == "collinear":
        x[:, 2] = 2 * x[:, 0] - x[:, 1] + 5
    else:
        x = 1e6 + 0.01 * x
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    c = linear.fit(df, ["a", "b", "c"], "y").first()
    got = x @ [c["b0"], c["b1"], c["b2"]] + c["intercept"]
    a = np.c_[x - x.mean(axis=0), np.ones(300)]
    assert np.abs(got - a @ np.linalg.lstsq(a, y, rcond=None)[0]).max() < 1e-6


def test_metrics_count_scored_rows(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None), (3.0, 2.0)], "y double, p double")
    m = metrics.metrics(df, "y", "p", unscored=True).first()
    assert (m["rows"], m["unscored"], m["MAE"]) == (2, 1, 0.75)
    zero = spark.createDataFrame([(0.0, 1.0)], "b double, m double").select(metrics.improvement(F.col("b"), F.col("m")).alias("i")).first()
    assert zero["i"] is None


@pytest.mark.parametrize("mode", ["panel", "ticker", "calendar"])
def test_null_index_value_is_filled(spark, mode):
    feat = spark.createDataFrame([(day(10 + k), "A", 1.0) for k in range(4)], "date date, ticker string, ret double")
    series = [(day(k), None if k == 12 else float(20 + k % 3)) for k in range(0, 16)]
    m = market.market_features(spark.createDataFrame(series, "date date, vix double"))
    got = {r["date"]: r["vix"] for r in market.with_market(feat, m.where("date >= DATE'2024-01-01'"), mode).collect()}
    assert len(got) == 4 and got[day(12)] == got[day(11)]


def test_market_series_needs_one_row_per_date(spark):
    twice = spark.createDataFrame([(day(1), 1.0, 1.0, 1.0), (day(1), 2.0, 1.0, 1.0)], "date date, vix double, vix_5 double, vix_chg double")
    with pytest.raises(Exception, match="market series has 2 rows"):
        market.one_per_date(twice).collect()
    with pytest.raises(TypeError):
        require_date(spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' AS date"))


def test_free_garch_converges_and_reports_status(spark):
    rnd = random.Random(3)
    rows = [("up", day(k), rnd.gauss(0, 0.01 * (1 + (k // 40) % 3))) for k in range(400)] + [("flat", day(k), 0.0) for k in range(50)] + [("one", day(0), 0.1)]
    got = {r["ticker"]: r for r in garch.garch_fit(spark.createDataFrame(rows, "ticker string, date date, ret double")).collect()}
    assert got["up"]["converged"] and got["up"]["status"] == "fitted"
    assert (got["flat"]["status"], got["one"]["status"]) == ("constant", "short") and got["flat"]["garch_vol"] is None
    r = np.array([x[2] for x in rows[:400]]) * 100
    a, b, w = got["up"]["alpha"], got["up"]["beta"], got["up"]["omega"]
    vbar = np.array([[(r * r).mean()]])

    def ll(a, b, w):
        return garch._recursion((r * r)[None, :], np.array([400]), np.array([[w]]), np.array([[a]]), np.array([[b]]), vbar[0])[0][0, 0]

    best = ll(a, b, w)
    for da, db, f in [(0.01, 0, 1), (-0.01, 0, 1), (0, 0.01, 1), (0, -0.01, 1), (0, 0, 1.05), (0, 0, 0.95)]:
        if a + da >= 0 and b + db >= 0 and a + da + b + db < 1:
            assert ll(a + da, b + db, w * f) <= best + 1e-3


def test_saved_forest_scores_alike(spark, tmp_path):
    clean = q.clean_panel(spark, SF001).limit(400).cache()
    model = trees.fit_model(clean, V1, trees.forest(3, 3), log_target=True)
    models.save_ml(model, models.model_meta(clean), str(tmp_path / "b"), V1, log_target=True, cutoff="2024-01-01", partitions=trees.PARTITIONS)
    bundle = models.load_ml(spark, str(tmp_path / "b"))
    assert bundle[1]["cutoff_date"] == "2024-01-01" and bundle[1]["log_space"]
    got = models.predict_ml(clean, bundle).select("ticker", "date", "pred").collect()
    assert len(got) == clean.count() and all(r["pred"] > 0 for r in got)


def test_worker_code_travels_with_the_functions(tmp_path):
    """A session started in another folder, whose workers cannot import the package."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from volpanel.session import local_session
from volpanel.operators import garch
s = local_session(2, 2)
df = s.createDataFrame([('A', k, 0.01 * (k % 5 - 2)) for k in range(60)], 'ticker string, date int, ret double')
print('ROWS', garch.garch_fit(df).count(), garch.garch_fit(df).first()['status'])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1 fitted" in out.stdout, out.stderr[-800:]
