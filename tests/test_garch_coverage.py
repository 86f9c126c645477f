"""Test rows of tickers without a GARCH forecast are counted."""

import datetime as dt

from helpers import SF001
from test_entry import duck  # noqa: F401
from volpanel.plans import oracle, queries


def test_rows_without_forecast_are_counted(spark, monkeypatch):
    day = dt.date(2020, 1, 1)
    made = [("a", day + dt.timedelta(k), 0.01 * (-1) ** k * (1 + k % 3), 0.02) for k in range(50)]
    made += [("late", day + dt.timedelta(k), 0.01, 0.02) for k in range(43, 50)]
    panel = spark.createDataFrame(made, "ticker string, date date, ret double, target_vol_fwd double")
    monkeypatch.setattr(queries, "clean_panel", lambda *_: panel)
    r = queries.REGISTRY["garch_split_coverage"](spark, "").first()
    scored = queries.REGISTRY["garch_split_metrics"](spark, "").first()
    # the cut is the date of row 45 of 57, day 44: six test rows each, and one training return of the late ticker
    assert r.rows == scored.rows == 6 and r.unscored == 6


def test_coverage_against_sql(spark, duck):
    got = queries.REGISTRY["garch_split_coverage"](spark, SF001).collect()
    assert [tuple(r) for r in got] == duck.sql(oracle.REGISTRY["garch_split_coverage"]).fetchall()
