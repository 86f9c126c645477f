"""Blocked (skew-safe) windows equal the plain per-ticker windows."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import SF01, prices_df
from volpanel.operators import features as feat
from volpanel.sources import panels


def _cmp(a, b, cols):
    ja = a.select("ticker", "date", *[F.col(c).alias(f"a_{c}") for c in cols])
    jb = b.select("ticker", "date", *[F.col(c).alias(f"b_{c}") for c in cols])
    j = ja.join(jb, ["ticker", "date"], "full_outer")
    assert j.count() == a.count() == b.count()
    for c in cols:
        bad = j.where(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")))
        bad = bad.where(F.col(f"a_{c}").isNull() | F.col(f"b_{c}").isNull() | (F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) > 1e-12))
        assert bad.count() == 0, (c, bad.limit(3).collect())


@pytest.mark.parametrize("block,parts", [(36, 3), (50, 7), (1000, 2)])
def test_blocked_equals_plain_on_hot_ticker(spark, block, parts):
    rnd = random.Random(block)
    rows, c = [], 100.0
    for i in range(400):  # one hot ticker with most of the rows, two small ones
        c *= 1 + rnd.uniform(-0.05, 0.05)
        rows.append((i, "HOT", c))
    for t in ("A", "B"):
        for i in range(45):
            rows.append((i, t, 50.0 + rnd.uniform(-1, 1)))
    rows[100] = (100, "HOT", 0.0)  # a zero close: NULL return, incomplete windows
    df = prices_df(spark, rows)
    _cmp(feat.add_features_blocked(df, rows_per_block=block, n_parts=parts), feat.add_features(df),
         ["close", "ret", "vol_5", "vol_10", "vol_30", "target_vol_fwd"])


def test_sequence_numbers_are_positions(spark):
    ticks = panels.user_ticks(spark, SF01)
    s = feat.sequence_numbers(ticks, n_parts=5)
    from pyspark.sql import Window

    ref = ticks.withColumn("pos", F.row_number().over(Window.partitionBy("ticker").orderBy("date")) - 1)
    j = s.join(ref, ["ticker", "date"])
    assert j.count() == ticks.count()
    assert j.where(F.col("seq") != F.col("pos")).count() == 0


def test_block_too_small_rejected(spark):
    with pytest.raises(ValueError):
        feat.add_features_blocked(prices_df(spark, [(0, "A", 1.0)]), rows_per_block=10)
