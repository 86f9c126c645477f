"""Refits from day statistics against full fits."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from volpanel.operators import increments, linear
from volpanel.sources import versions

FEATS = ["a", "b"]


def test_every_prefix_equals_a_full_fit(spark):
    r = random.Random(6)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(i // 9), 1000 + r.gauss(0, 1), r.random(), r.gauss(0, 1)) for i in range(180)]
    df = spark.createDataFrame([(d, a, b, 0.5 * a - 2 * b + e) for d, a, b, e in rows], "date date, a double, b double, y double").cache()
    path = tempfile.mkdtemp(prefix="volpanel-days-", dir="/tmp") + "/stats"
    assert increments.start(df.where("date < '2024-01-06'"), FEATS, "y", path) == 1
    # the second delivery holds days that are known already, one of them not whole before
    increments.add_days(spark, path, df.where("date >= '2024-01-04' and date < '2024-01-15' and a > 1000"), FEATS, "y")
    assert increments.add_days(spark, path, df.where("date >= '2024-01-04'"), FEATS, "y") == 3
    stats = versions.read(spark, path)
    assert stats.count() == 20 and stats.select("h0").distinct().count() == 1
    days = [d for (d,) in df.select("date").distinct().orderBy("date").collect()]
    each = {x["date"]: x for x in increments.refit_each(stats, 2, df.select("date")).collect()}
    assert sorted(each) == days
    for d in days[1:]:
        full = linear.fit(df.where(F.col("date") <= F.lit(d)), FEATS, "y").first()
        one = increments.refit(stats, 2, d).first()
        for got in (each[d], one):
            assert [got["b0"], got["b1"], got["intercept"]] == pytest.approx([full["b0"], full["b1"], full["intercept"]], rel=1e-7, abs=1e-6)
        assert each[d]["rows"] == df.where(F.col("date") <= F.lit(d)).count()
    assert increments.refit(stats, 2, dt.date(2023, 1, 1)).count() == 0
    with pytest.raises(ValueError, match="other features"):
        increments.add_days(spark, path, df, ["b", "a"], "y")
