"""Published tables: the predicted-versus-actual fact table and latest forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volpanel.functions.scalar import annualise
from volpanel.operators import features as feat
from volpanel.operators import linear
from volpanel.plans.evaluate import walk_forward_predictions
from volpanel.schemas import MIN_CLOSES, N_FOLDS, TARGET, V1
from volpanel.sources.files import fmt_date, lookback
from volpanel.functions.rows import with_row


def flag_latest(df: DataFrame, key: str = "ticker", col: str = "date") -> DataFrame:
    """``is_latest``: the row holds its ticker's last date (group max broadcast to rows)."""
    return df.withColumn("is_latest", F.col(col) == F.max(col).over(Window.partitionBy(key)))


def dashboard(clean: DataFrame, feats: list[str] = V1, n_folds: int = N_FOLDS) -> DataFrame:
    """One row per (ticker, date): annualised actual and predicted volatility.

    Values are annualised then rounded to 2 places; the error is the rounded
    difference of the rounded values.
    """
    scored = flag_latest(walk_forward_predictions(clean, feats, n_folds))
    act = F.round(annualise(F.col(TARGET)), 2)
    pred = F.round(annualise(F.col("pred")), 2)
    out = scored.select(
        fmt_date(F.col("date")).alias("date"),
        "ticker",
        "fold",
        act.alias("actual_vol"),
        pred.alias("predicted_vol"),
        "set",
        "is_latest",
    )
    err = F.round(F.col("predicted_vol") - F.col("actual_vol"), 2)
    out = out.withColumn("error", err).withColumn("abs_error", F.round(F.abs(err), 2))
    return out.select("date", "ticker", "fold", "actual_vol", "predicted_vol", "error", "abs_error", "set", "is_latest")


def dashboard_mae(dash: DataFrame) -> DataFrame:
    """MAE of the rounded annualised values per test fold, and overall (fold NULL), in one rollup."""
    test = dash.where(F.col("set") == "test")
    return test.rollup("fold").agg(
        F.avg(F.abs(F.col("predicted_vol") - F.col("actual_vol"))).alias("mae"),
        F.avg("abs_error").alias("mean_abs_error"),
        F.min("date").alias("start"),
        F.max("date").alias("end"),
        F.count(F.lit(1)).cast("long").alias("rows"),
    )


def latest_table(dash: DataFrame) -> DataFrame:
    """The most recent row per ticker (the input of the risk ranking)."""
    return dash.where(F.col("is_latest"))


def universe(spark, names: list[str] | None, default: list[str] | None = None) -> DataFrame:
    """Requested tickers, upper-cased (duplicates kept), as a small DataFrame."""
    names = [n.upper() for n in (names or default or ["AAPL"])]
    return spark.createDataFrame([(n,) for n in names], "ticker string")


def enough_history(prices: DataFrame, n: int = MIN_CLOSES) -> DataFrame:
    """Rows of tickers with at least ``n`` non-null closes (a per-ticker count)."""
    return prices.withColumn("_n", F.count("close").over(Window.partitionBy("ticker"))).where(F.col("_n") >= n).drop("_n")


def latest_row(df: DataFrame, cols: list[str], key: str = "ticker", order: str = "date") -> DataFrame:
    """The last row of each key (one partial + final aggregate; no sort of the key's rows)."""
    return df.groupBy(key).agg(F.max_by(F.struct(order, *cols), F.col(order)).alias("_x")).select(key, "_x.*")


def missing_tickers(requested: DataFrame, prices: DataFrame) -> DataFrame:
    """Requested tickers that did not arrive in the panel (anti join)."""
    return requested.join(prices.select("ticker").distinct(), "ticker", "left_anti")


def forecast_latest(prices: DataFrame, model: DataFrame, as_of=None, months: int = 6, tickers: DataFrame | None = None) -> DataFrame:
    """Latest forecast per ticker from the last ``months`` of closes before ``as_of``.

    Output: ticker, as_of (last close date), recent_vol_5, pred_daily_vol, pred_annual_%
    (rounded 5, 5, 1 places).  Tickers with fewer than 31 closes are skipped.  A model
    trained in log space is scored back in volatility units.
    """
    closes = prices.select("date", "ticker", "close").where(F.col("close").isNotNull())
    if tickers is not None:
        closes = closes.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    if as_of is not None:
        closes = lookback(closes, as_of, months)
    closes = enough_history(closes)
    last_close = closes.groupBy("ticker").agg(F.max("date").alias("as_of"))
    f = feat.add_vols(feat.add_return(closes), method="std")
    f = feat.clean_any(f, V1)
    latest = latest_row(f, V1).drop("date")
    m = model.select("coef", "intercept", F.coalesce(F.col("log_space"), F.lit(False)).alias("log_space"))
    scored = with_row(latest, m)
    raw = linear.score_with(scored, m, V1, "raw")
    scored = scored.select("ticker", "vol_5", F.when(F.col("log_space"), F.exp(raw)).otherwise(raw).alias("pred"))
    out = scored.join(last_close, "ticker").select(
        "ticker",
        "as_of",
        F.round("vol_5", 5).alias("recent_vol_5"),
        F.round("pred", 5).alias("pred_daily_vol"),
        F.round(annualise(F.col("pred")), 1).alias("pred_annual_%"),
    )
    return out


def request_status(requested: DataFrame, prices: DataFrame, as_of, months: int = 6) -> DataFrame:
    """What becomes of every requested ticker: ``forecast``, ``skipped`` (too few closes) or ``absent``."""
    closes = lookback(prices.select("date", "ticker", "close").where(F.col("close").isNotNull()), as_of, months)
    n = closes.groupBy("ticker").agg(F.count("close").alias("closes"))
    known = requested.select("ticker").distinct().join(n, "ticker", "left")
    status = F.when(F.col("closes") >= MIN_CLOSES, "forecast").when(F.col("closes") > 0, "skipped").otherwise("absent")
    return known.select("ticker", F.coalesce("closes", F.lit(0)).cast("long").alias("closes"), status.alias("status"))


def rank_forecasts(fc: DataFrame) -> DataFrame:
    return fc.orderBy(F.col("pred_annual_%").desc(), F.col("ticker").asc())
