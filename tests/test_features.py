import math

import pytest
from pyspark.sql import functions as F

from helpers import day, prices_df
from volpanel.operators import features as feat


def collect(df, order=("ticker", "date")):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_const_return(spark):
    rows = [(i, "A", 100.0 * 1.01**i) for i in range(40)]
    f = collect(feat.add_features(prices_df(spark, rows)))
    assert f[0]["ret"] is None
    assert all(abs(r["ret"] - 0.01) < 1e-12 for r in f[1:])
    for r in f:
        for c in ("vol_5", "vol_10", "vol_30"):
            assert r[c] is None or abs(r[c]) < 1e-9
    clean = feat.clean_v1(feat.add_features(prices_df(spark, rows)))
    assert clean.count() == 40 - 35


def test_zigzag(spark):
    rows = [(i, "Z", 100.0 if i % 2 == 0 else 110.0) for i in range(36)]
    f = collect(feat.add_features(prices_df(spark, rows)))
    assert abs(f[1]["ret"] - 0.1) < 1e-12
    assert abs(f[2]["ret"] - (100.0 / 110.0 - 1.0)) < 1e-12
    clean = collect(feat.clean_v1(feat.add_features(prices_df(spark, rows))))
    assert len(clean) == 1 and clean[0]["date"] == day(30)
    # the target at row t is vol_5 at row t + 5
    for t in range(len(f) - 5):
        assert f[t]["target_vol_fwd"] == f[t + 5]["vol_5"]
    assert all(r["target_vol_fwd"] is None for r in f[-5:])


def test_zero_close_gives_null_not_error(spark):
    closes = [100.0 + i for i in range(40)]
    closes[10] = 0.0
    f = collect(feat.add_features(prices_df(spark, [(i, "A", c) for i, c in enumerate(closes)])))
    assert f[10]["ret"] == pytest.approx(-1.0)
    assert f[11]["ret"] is None
    # every window that holds row 11 is incomplete
    for t in range(11, 16):
        assert f[t]["vol_5"] is None
    assert f[16]["vol_5"] is not None


def test_null_close(spark):
    closes = [100.0 + i for i in range(40)]
    closes[12] = None
    f = collect(feat.add_features(prices_df(spark, [(i, "A", c) for i, c in enumerate(closes)])))
    assert f[12]["ret"] is None and f[13]["ret"] is None
    assert all(f[t]["vol_30"] is None for t in range(40))


def test_no_bleeding_across_tickers(spark):
    rows = [(i, "A", 100.0 + i) for i in range(40)] + [(i, "B", 500.0 - i) for i in range(40)]
    f = collect(feat.add_features(prices_df(spark, rows)))
    a = [r for r in f if r["ticker"] == "A"]
    b = [r for r in f if r["ticker"] == "B"]
    assert a[0]["ret"] is None and b[0]["ret"] is None
    assert a[-1]["target_vol_fwd"] is None and b[-1]["target_vol_fwd"] is None
    assert b[1]["ret"] == pytest.approx(499.0 / 500.0 - 1.0)


def test_sumsq_equals_stddev(spark):
    import random

    rnd = random.Random(7)
    rows, c = [], 100.0
    for i in range(120):
        c *= 1 + rnd.uniform(-0.05, 0.05)
        rows.append((i, "R", c))
    a = collect(feat.add_features(prices_df(spark, rows), method="sumsq"))
    b = collect(feat.add_features(prices_df(spark, rows), method="std"))
    for x, y in zip(a, b):
        for col in ("vol_5", "vol_10", "vol_30", "target_vol_fwd"):
            if x[col] is None:
                assert y[col] is None
            else:
                assert abs(x[col] - y[col]) < 1e-9


def test_high_eq_low_range_features(spark):
    rows = [(i, "H", 100.0 + i, 100.0 + i, 100.0 + i, 10.0 + i) for i in range(45)]
    v2 = collect(feat.add_features_v2(prices_df(spark, rows)))
    assert v2, "some complete rows"
    assert all(r["range_hl"] == 0.0 and r["parkinson_5"] == 0.0 for r in v2)


def test_parkinson_and_volume_ratio(spark):
    rows = [(i, "P", 100.0, 110.0, 100.0, float(10 + i)) for i in range(45)]
    v2 = collect(feat.add_features_v2(prices_df(spark, rows)))
    park = math.sqrt(math.log(1.1) ** 2 / (4 * math.log(2)))
    assert all(abs(r["parkinson_5"] - park) < 1e-12 for r in v2)
    r = v2[0]
    i = (r["date"] - day(0)).days
    mean20 = sum(10 + j for j in range(i - 19, i + 1)) / 20.0
    assert r["vol_ratio"] == pytest.approx((10 + i) / mean20)


def test_one_exchange_for_all_windows(spark):
    rows = [(i, t, 100.0 + i * (1 if t == "A" else 2)) for t in "AB" for i in range(40)]
    plan = feat.add_features(prices_df(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_clean_any_drops_nan_keeps_inf(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, None), (4, 1.0)], "k int, x double")
    kept = sorted(r.k for r in feat.clean_any(df, ["x"]).collect())
    assert kept == [2, 4]


def test_other_horizon_uses_its_own_window(spark):
    import random

    rnd = random.Random(3)
    rows, c = [], 100.0
    for i in range(60):
        c *= 1 + rnd.uniform(-0.05, 0.05)
        rows.append((i, "H", c))
    df = prices_df(spark, rows)
    f7 = collect(feat.add_features(df, horizon=7))
    v7 = collect(feat.add_vols(feat.add_return(df.select("date", "ticker", "close")), "sumsq", (7,)))
    for t in range(len(f7) - 7):
        assert f7[t]["target_vol_fwd"] == v7[t + 7]["vol_7"]
    assert "vol_7" not in f7[0]


def test_every_window_sum_is_evaluated_once(spark):
    """The volatility formula names its window sums several times; each used to be evaluated for every naming."""
    import re

    f = feat.add_features(prices_df(spark, [(0, "A", 1.0)]))
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\b(?:sum|count)\([^()]*\) windowspecdefinition", plan)) == 9  # count, sum, sum of squares of three windows
