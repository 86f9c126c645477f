"""Shared helpers of the tests (a module of its own name: folders may each have a conftest)."""

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from volpanel.schemas import PRICES  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def day(i: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def prices_df(spark, rows):
    """rows: (day index, ticker, close[, high, low, volume]) → PRICES DataFrame."""
    out = []
    for r in rows:
        i, t, c = r[0], r[1], r[2]
        hi = r[3] if len(r) > 3 else c
        lo = r[4] if len(r) > 4 else c
        vol = r[5] if len(r) > 5 else 100.0
        out.append((day(i), t, c, hi, lo, c, vol))
    return spark.createDataFrame(out, PRICES)
