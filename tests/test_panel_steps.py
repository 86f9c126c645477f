"""The steps every panel query shares: supplier days and rolling windows, in the form that large panels need."""

import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import SF001, prices_df
from volpanel.operators import features as feat
from volpanel.plans import queries as q
from volpanel.sources import panels


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_supplier_days_are_dealt_and_sorted_once(spark):
    """The lines used to be sorted on both sides of the exchange, with the order keys of open and close as buffers."""
    plan = executed(panels.supplier_day(spark, SF001))
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    assert plan.index("Sort [") < plan.index("Exchange")  # above it


@pytest.mark.parametrize("panel", [q.clean_panel, q.v2_panel])
def test_no_long_frame_slides(spark, panel):
    """A frame of 30 rows used to be summed anew for every row."""
    frames = re.findall(r"RowFrame, -(\d+), currentrow", executed(panel(spark, SF001)))
    assert frames and max(map(int, frames)) == 4


def odd_prices():
    rnd = random.Random(11)
    rows = []
    for t in "AB":
        c = 100.0
        for i in range(150):
            c *= 1 + rnd.uniform(-0.05, 0.05)
            close = {20: 0.0, 40: None, 60: 1e-9, 61: 1e9, 100: float("nan")}.get(i, c) if t == "A" else c
            rows.append((i, t, close, 2 * c, c / 2, float(1 + i % 7)))
    return rows


@pytest.mark.parametrize("kind", ["sumsq", "std", "mean"])
@pytest.mark.parametrize("lengths", [(5, 10, 30), (5, 7, 20), (2, 3), (4,)])
def test_windows_of_blocks_equal_sliding_ones(spark, kind, lengths):
    """Zero, missing, NaN and huge prices included: they stay in their own windows."""
    df = feat.add_return(prices_df(spark, odd_prices()).select("date", "ticker", "close")).cache()
    plain = df.select("*", *[(feat.rolling_mean if kind == "mean" else feat.rolling_vol)(F.col("ret"), n).alias(f"w{n}") for n in lengths])
    if kind == "sumsq":
        plain = feat.add_vols(df, "sumsq", lengths).withColumnsRenamed({f"vol_{n}": f"w{n}" for n in lengths})
    got = feat.add_from_blocks(df, {f"w{n}": (kind, "ret", n) for n in lengths})
    assert got.columns == plain.columns
    a, b = [x.orderBy("ticker", "date").collect() for x in (got, plain)]
    assert len(a) == len(b) == 300
    for x, y in zip(a, b):
        for n in lengths:
            u, v = x[f"w{n}"], y[f"w{n}"]
            assert (u is None) == (v is None), (x["ticker"], x["date"], n)
            assert u is None or u == pytest.approx(v, rel=1e-9, abs=1e-8, nan_ok=True)


def test_market_reads_the_panel_dates_from_one_small_table(spark):
    """The bounds, the test for missing dates and the calendar each used to pass over the whole panel."""
    assert any("/dates-" in f for f in q.v3_panel(spark, SF001).inputFiles())


def test_board_keeps_only_what_it_reads(spark):
    folded = q.board_panel(spark, SF001)
    assert "fold" in folded.columns and not {"ticker", "close"} & set(folded.columns)
    assert folded.count() == q.v3_panel(spark, SF001).count()
