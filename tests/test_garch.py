import math
import random

from helpers import prices_df
from volpanel.operators import features as feat
from volpanel.operators import garch


def python_loglik(r, a, b):
    vbar = sum(x * x for x in r) / len(r)
    omega = vbar * (1.0 - a - b)
    s2, ll = vbar, 0.0
    for x in r:
        ll -= 0.5 * (math.log(2 * math.pi) + math.log(s2) + x * x / s2)
        s2 = omega + a * x * x + b * s2
    return ll, s2, vbar


def series(spark, n=300, seed=11):
    rnd = random.Random(seed)
    c, rows, s2 = 100.0, [], 1e-4
    for i in range(n):
        s2 = 2e-6 + 0.1 * (rnd.gauss(0, math.sqrt(s2)) ** 2) + 0.85 * s2
        c *= 1 + rnd.gauss(0, math.sqrt(s2))
        rows.append((i, "G", c))
    f = feat.add_features(prices_df(spark, rows)).where("ret IS NOT NULL")
    return f


def test_grid_matches_python_recursion(spark):
    f = series(spark)
    rets = [r["ret"] * 100.0 for r in f.orderBy("date").collect()]
    g = garch.garch_grid(f).first()
    best = max(garch.GRID, key=lambda ab: python_loglik(rets, *ab)[0])
    assert (g["alpha"], g["beta"]) == best
    ll, s2, vbar = python_loglik(rets, *best)
    assert abs(g["loglik"] - ll) < 1e-6 * abs(ll)
    phi = sum(best)
    var = sum(vbar + (s2 - vbar) * phi**h for h in range(5)) / 5
    assert abs(g["garch_vol"] - math.sqrt(var) / 100) < 1e-12


def test_free_fit_at_least_as_likely_as_grid(spark):
    f = series(spark, seed=5)
    g = garch.garch_grid(f).first()
    r = garch.garch_fit(f).first()
    assert r["alpha"] + r["beta"] < 1 and r["omega"] > 0
    assert r["loglik"] >= g["loglik"] - 1e-6
    assert r["garch_vol"] > 0


def test_likelihood_in_pieces_equals_the_fold(spark):
    """A hot key in many pieces and partitions, short keys, and keys without a likelihood."""
    import datetime as dt
    import random

    import pytest

    r = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(seconds=i), r.gauss(0, 0.02) * (3 if i % 500 < 100 else 1)) for i in range(4000)]
    rows += [(f"k{k}", t0 + dt.timedelta(seconds=i), r.gauss(0, 0.01) if i else None) for k in range(6) for i in range(3 + 9 * k)]
    rows += [("one", t0, 0.1), ("flat", t0, 0.0), ("flat", t0 + dt.timedelta(1), 0.0)]
    df = spark.createDataFrame(rows, "ticker string, date timestamp, ret double")
    series = {}
    for k, d, x in rows:
        if x is not None:
            series.setdefault(k, []).append((d, x * 100))
    for pieces, parts in ((37, 9), (100_000, 1)):
        got = {x.ticker: x for x in garch.loglik_in_pieces(df, 0.08, 0.9, n_parts=parts, rows_per_piece=pieces).collect()}
        assert set(got) == {"hot", *[f"k{k}" for k in range(6)]}
        for k, x in got.items():
            xs = [v for _, v in sorted(series[k])]
            vbar = sum(v * v for v in xs) / len(xs)
            s2, ll = vbar, 0.0
            for v in xs:
                ll -= 0.5 * (garch.LN_2PI + math.log(s2) + v * v / s2)
                s2 = vbar * (1 - 0.08 - 0.9) + 0.08 * v * v + 0.9 * s2
            assert (x.n, x.vbar, x.s2, x.loglik) == pytest.approx((len(xs), vbar, s2, ll), rel=1e-9)
    with pytest.raises(ValueError):
        garch.loglik_in_pieces(df, 0.5, 0.6)


def test_free_fit_of_a_series_does_not_depend_on_its_batch():
    """Series used to be searched until the slowest of their batch was done."""
    import numpy as np

    r = np.random.default_rng(0)
    series = [r.normal(size=int(k)) * (1 + (np.arange(int(k)) // 40) % 3) for k in r.integers(60, 90, 12)]
    together = garch.fit_batch(series, 5)
    assert together == [garch.fit_batch([s], 5)[0] for s in series]
    assert together == garch.fit_batch(series[::-1], 5)[::-1]
