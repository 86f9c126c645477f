"""Distributed algorithms against plain pandas on small random fixtures."""

import random

import numpy as np
import pandas as pd
import pytest

from helpers import day
from volpanel.operators import market, splits


@pytest.mark.parametrize("seed,blocks", [(1, 1), (2, 3), (3, 7)])
def test_blocked_ffill_equals_frame_ffill(spark, seed, blocks):
    rnd = random.Random(seed)
    rows = []
    for t in range(25):
        for d in range(8):
            vals = [None if rnd.random() < 0.45 else float(rnd.randint(1, 99)) for _ in range(2)]
            rows.append((f"T{t:02d}", day(d), *vals))
    pdf = pd.DataFrame(rows, columns=["ticker", "date", "a", "b"])
    expect = pdf.sort_values(["ticker", "date"]).reset_index(drop=True)
    expect[["a", "b"]] = expect[["a", "b"]].ffill()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "ticker string, date date, a double, b double")
    got = market.ffill_panel(df, ["a", "b"], blocks=blocks).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[["ticker", "a", "b"]], expect[["ticker", "a", "b"]], check_dtype=False)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_fold_edges_equal_pd_cut(spark, seed):
    rnd = np.random.default_rng(seed)
    dates = pd.to_datetime("2020-01-01") + pd.to_timedelta(rnd.integers(0, 60, size=300), unit="D")
    pdf = pd.DataFrame({"date": dates})
    known = sorted(set(pdf["date"]))
    opens = [known[k * len(known) // 5] for k in (1, 2, 3, 4)]  # the days on which folds 1..4 open
    expect = [sum(d >= o for o in opens) for d in pdf["date"]]
    df = spark.createDataFrame(pd.DataFrame({"date": pdf["date"].dt.date}))
    got = splits.assign_folds(df).toPandas()
    m = dict(zip(got["date"], got["fold"]))
    assert [m[d] for d in pdf["date"].dt.date] == list(expect)


@pytest.mark.parametrize("seed,q", [(7, 0.8), (8, 0.6), (9, 0.2)])
def test_row_weighted_cutoff_equals_sorted_index(spark, seed, q):
    rnd = np.random.default_rng(seed)
    dates = pd.to_datetime("2021-01-01") + pd.to_timedelta(rnd.geometric(0.1, size=500), unit="D")
    s = dates.sort_values()
    expect = s[int(len(s) * q)].date()
    df = spark.createDataFrame(pd.DataFrame({"date": dates.date}))
    assert splits.cutoff_dates(df, [q]).first()["c0"] == expect
