import math

from pyspark.sql import functions as F

from helpers import SF01, day, prices_df
from volpanel.functions.scalar import rounded_error
from volpanel.plans import publish, serve
from volpanel.plans import queries as q
from volpanel.schemas import V1


def test_rounding_order(spark):
    df = spark.createDataFrame([(10.004, 10.016)], "a double, p double")
    r = df.select(
        F.round("a", 2).alias("a2"), F.round("p", 2).alias("p2"), rounded_error(F.col("p"), F.col("a")).alias("e")
    ).first()
    assert (r["a2"], r["p2"], r["e"]) == (10.0, 10.02, 0.02)


def test_dashboard_shape_and_latest(spark):
    dash = q.q_dashboard(spark, SF01)
    assert dash.columns == ["date", "ticker", "fold", "actual_vol", "predicted_vol", "error", "abs_error", "set", "is_latest"]
    assert dash.count() == 49807
    assert dash.where("is_latest").count() == dash.select("ticker").distinct().count()
    sets = {r["set"]: r["n"] for r in dash.groupBy("set").agg(F.count("*").alias("n")).collect()}
    assert sets == {"train": 9514, "test": 49807 - 9514}
    mae = publish.dashboard_mae(dash).collect()
    assert len(mae) == 5 and any(r["fold"] is None for r in mae)


def _model(spark):
    coefs = spark.createDataFrame([(0.1, 0.2, 0.3, 0.4, 0.001)], "b0 double, b1 double, b2 double, b3 double, intercept double")
    return serve.model_row(coefs, V1)


def test_thirty_vs_thirty_one_closes(spark):
    rows = [(i, "THIRTY", 100.0 + math.sin(i)) for i in range(30)] + [(i, "THIRTYONE", 100.0 + math.cos(i)) for i in range(31)]
    fc = publish.forecast_latest(prices_df(spark, rows), _model(spark)).collect()
    assert [r["ticker"] for r in fc] == ["THIRTYONE"]
    r = fc[0]
    assert set(r.asDict()) == {"ticker", "as_of", "recent_vol_5", "pred_daily_vol", "pred_annual_%"}


def test_universe_upper_case_keeps_duplicates(spark):
    u = publish.universe(spark, ["aapl", "msft", "aapl"])
    assert [r["ticker"] for r in u.collect()] == ["AAPL", "MSFT", "AAPL"]
    assert [r["ticker"] for r in publish.universe(spark, []).collect()] == ["AAPL"]


def test_forecast_universe_and_missing(spark):
    rows = [(i, t, 100.0 + math.sin(i + k)) for k, t in enumerate(["AAA", "BBB"]) for i in range(40)]
    prices = prices_df(spark, rows)
    u = publish.universe(spark, ["aaa", "zzz"])
    fc = publish.forecast_latest(prices, _model(spark), tickers=u).collect()
    assert [r["ticker"] for r in fc] == ["AAA"]
    assert [r["ticker"] for r in publish.missing_tickers(u, prices).collect()] == ["ZZZ"]


def test_assert_unique(spark):
    import pytest
    from volpanel.sources.files import assert_unique

    ok = prices_df(spark, [(0, "A", 1.0), (1, "A", 2.0)])
    assert_unique(ok)
    with pytest.raises(ValueError, match="duplicate keys"):
        assert_unique(prices_df(spark, [(0, "A", 1.0), (0, "A", 2.0)]))


def test_csv_round_trip_and_ordering(spark):
    import tempfile

    from volpanel.sources import files

    rows = [(i, t, 100.0 + i, 101.0 + i, 99.0 + i, 1000.0 + i) for t in ("B", "A") for i in range(5)]
    df = prices_df(spark, rows)
    path = tempfile.mkdtemp(prefix="volpanel-csv-", dir="/tmp") + "/prices"
    files.write_csv(files.ordered(df, within_partitions=True), path)
    back = files.read_prices(spark, path, "csv")
    assert [f.dataType for f in back.schema.fields] == [f.dataType for f in df.schema.fields]
    assert back.count() == 10
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    first = files.preview(df, 2).collect()
    assert [(r["ticker"], r["date"]) for r in first] == [("A", day(0)), ("A", day(1))]


def test_latest_row(spark):
    rows = [(i, t, float(10 * k + i)) for k, t in enumerate(["A", "B"]) for i in range(5)]
    got = {r["ticker"]: r["close"] for r in publish.latest_row(prices_df(spark, rows), ["close"]).collect()}
    assert got == {"A": 4.0, "B": 14.0}
