"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Outputs are shaped for the oracle comparison: every computed column is aliased,
derived doubles are rounded to 6 places (2 for annualised percent), raw prices are
left unrounded (short decimals can be exact rounding ties).  Every query reads the
whole test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volpanel.operators import features as feat
from volpanel.operators import garch, increments, linear, market, splits
from volpanel.operators import metrics as metrics_mod
from volpanel.operators import sketch as sk
from volpanel.plans import evaluate, publish, serve
from volpanel.schemas import BASELINE, FEATURE_SETS, TARGET, V1, V2
from volpanel.session import reuse, write_once, write_path
from volpanel.sources import files, panels, versions
from volpanel.functions.rows import with_row

# ret is left unrounded: it is one IEEE division in both engines (bit-identical), and a
# quotient of short decimals can be an exact rounding tie (H7)
R6_V1 = ["vol_5", "vol_10", "vol_30", "target_vol_fwd"]
R6_V2 = R6_V1 + ["range_hl", "range_5", "parkinson_5"]
R6_V3 = R6_V2 + ["vix_5", "vix_chg"]
METRIC_COLS = ["RMSE", "MAE", "R2"]


def rounded(df: DataFrame, cols: list[str], k: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), k).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- building blocks shared by several queries -----------------------------

def clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.clean_v1(feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks"))


def stored_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean panel, written once for queries that read it several times."""
    return write_once(clean_panel(spark, sf_dir), "clean")


def v2_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.add_features_v2(panels.supplier_day(spark, sf_dir))


def v3_panel(spark: SparkSession, sf_dir: str, mode: str = "calendar") -> DataFrame:
    return market.add_market(v2_panel(spark, sf_dir), panels.market_day(spark, sf_dir), mode)


def board_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded ``features_v3`` with the columns that a linear board reads: the panel is kept for several passes."""
    cols = dict.fromkeys(["date", BASELINE, TARGET, *[f for feats in FEATURE_SETS.values() for f in feats]])
    return splits.assign_folds(v3_panel(spark, sf_dir).select(*cols))


def final_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped model: linear on v1, refitted on all clean rows."""
    coefs = linear.fit(stored_clean(spark, sf_dir), V1, TARGET)
    return serve.model_row(coefs, V1)


# ---- features ---------------------------------------------------------------

def q_features_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clean_panel(spark, sf_dir), R6_V1)


def q_preview_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six clean rows in (ticker, date) order (a top-n, the preview itself)."""
    return files.preview(q_features_clean(spark, sf_dir), 6)


def q_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, warm-up and tail NULLs included (std form of the volatility)."""
    f = feat.add_features(panels.supplier_day(spark, sf_dir), method="std")
    return rounded(f, R6_V1)


def q_features_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(v2_panel(spark, sf_dir), R6_V2)


def q_features_v2_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feat.add_features_v2(panels.flag_day(spark, sf_dir)), R6_V2)


def q_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.add_return(panels.supplier_day(spark, sf_dir).select("date", "ticker", "close"))


def q_rolling_vol_sumsq(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks")
    return rounded(f.select("date", "ticker", "vol_5", "vol_10", "vol_30"), ["vol_5", "vol_10", "vol_30"])


def q_forward_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks")
    return rounded(f.select("date", "ticker", "vol_5", TARGET), ["vol_5", TARGET])


def _v2_raw(spark: SparkSession, sf_dir: str, panel) -> DataFrame:
    return feat.add_features_v2(panel(spark, sf_dir), clean=False)


def q_range_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _v2_raw(spark, sf_dir, panels.flag_day)
    return rounded(v.select("date", "ticker", "range_hl", "range_5"), ["range_hl", "range_5"])


def q_parkinson(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _v2_raw(spark, sf_dir, panels.flag_day)
    return rounded(v.select("date", "ticker", "parkinson_5"), ["parkinson_5"])


def q_volume_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _v2_raw(spark, sf_dir, panels.supplier_day)
    return v.select("date", "ticker", "vol_ratio")


def q_tick_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1 features on the tick panel (one close per event), in the skew-safe blocked form."""
    f = feat.add_features_blocked(panels.user_ticks(spark, sf_dir))
    return rounded(f, R6_V1)


def q_tick_features_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in blocks of 48 ticks, so that the windows of most users cross block boundaries."""
    f = feat.add_features_blocked(panels.user_ticks(spark, sf_dir), rows_per_block=48)
    return rounded(f, R6_V1)


def q_market_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = panels.market_day(spark, sf_dir)
    return rounded(market.market_features(m), ["vix_5", "vix_chg"])


def _v3(mode: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(v3_panel(spark, sf_dir, mode), R6_V3)

    q.__name__ = f"q_features_v3_{mode}"
    return q


# ---- splits -------------------------------------------------------------------

def q_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = splits.cutoff_dates(clean_panel(spark, sf_dir), [1.0 - 0.2, 0.6, 0.8])
    return c.select(F.col("c0").alias("cutoff_80"), F.col("c1").alias("d1_60"), F.col("c2").alias("d2_80"))


def q_split_two_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = splits.split_two(clean_panel(spark, sf_dir))
    return s.groupBy("set").agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.min("date").alias("start"), F.max("date").alias("end")
    )


def q_split_three_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = splits.split_three(v2_panel(spark, sf_dir))
    return s.groupBy("set").agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.min("date").alias("start"), F.max("date").alias("end")
    )


def q_fold_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.fold_calendar(clean_panel(spark, sf_dir))


def q_fold_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.fold_profile(splits.assign_folds(clean_panel(spark, sf_dir)))


def q_fold_profile_v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold ranges and sizes of the walk-forward comparison, which runs on features_v3."""
    return splits.fold_profile(splits.assign_folds(v3_panel(spark, sf_dir)))


# ---- evaluation ---------------------------------------------------------------

def q_naive_walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.assign_folds(clean_panel(spark, sf_dir))
    return rounded(evaluate.naive_walk_forward(folded), METRIC_COLS)


def q_walk_forward_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.assign_folds(clean_panel(spark, sf_dir))
    return rounded(evaluate.walk_forward_metrics(folded, V1), METRIC_COLS)


def q_walk_forward_linear_purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk-forward linear v1 without the rows whose 5-day target overlaps the test fold."""
    f = feat.clean_v1(feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks", target_end=True))
    folded = splits.assign_folds(f, purge_col="target_end")
    return rounded(evaluate.walk_forward_metrics(folded, V1, purge=True), METRIC_COLS)


def q_walk_forward_linear_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.assign_folds(v2_panel(spark, sf_dir))
    return rounded(evaluate.walk_forward_metrics(folded, V2), METRIC_COLS)


def q_walk_forward_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear candidates on v1/v2/v3 over ``features_v3`` + the naive row: mean and std of fold RMSE."""
    folded = board_panel(spark, sf_dir)
    board = evaluate.linear_board(folded, FEATURE_SETS, with_naive=True).drop("fold_RMSEs")
    return rounded(board, ["mean_RMSE", "std_RMSE"])


def q_walk_forward_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best linear candidate of the walk-forward board and its improvement over the naive
    baseline, from the unrounded fold means (as the source computes it)."""
    folded = board_panel(spark, sf_dir)
    board = evaluate.linear_board(folded, FEATURE_SETS, with_naive=True)
    lin = board.where(F.col("model") == "Linear")
    win = lin.agg(F.min_by(F.struct("features", "model", "mean_RMSE", "std_RMSE"), F.struct("mean_RMSE", "features")).alias("w"))
    base = board.where(F.col("model") == "Naive").select(F.col("mean_RMSE").alias("base"))
    j = with_row(win.select("w.*"), base)
    return j.select(
        "features", "model",
        F.round("mean_RMSE", 6).alias("mean_RMSE"), F.round("std_RMSE", 6).alias("std_RMSE"),
        F.round(F.col("base"), 6).alias("baseline_RMSE"),
        F.round(metrics_mod.improvement(F.col("base"), F.col("mean_RMSE")), 1).alias("improvement_pct"),
    )


def q_walk_forward_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = evaluate.walk_forward_predictions(clean_panel(spark, sf_dir))
    return rounded(p.select("date", "ticker", "fold", "set", TARGET, "pred"), [TARGET, "pred"])


def q_documented_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.documented_metrics(clean_panel(spark, sf_dir)).drop("fold_RMSEs")


def q_naive_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive forecast on the test rows of the single 80/20 split: rows, RMSE, MAE, R²."""
    s = splits.split_two(clean_panel(spark, sf_dir)).where(F.col("set") == "test")
    return rounded(metrics_mod.metrics(evaluate.naive(s), TARGET, "pred"), METRIC_COLS)


def q_split_two_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.split_two_scored(stored_clean(spark, sf_dir)), METRIC_COLS)


def q_split_two_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best model of the single-split board and its improvement over the naive baseline.

    As in the source, the board is rounded to 6 places before the comparison.
    """
    board = rounded(evaluate.split_two_scored(stored_clean(spark, sf_dir)), ["RMSE"])
    return board.agg(
        F.min_by("model", F.struct("RMSE", "model")).alias("best_model"),
        F.min("RMSE").alias("best_RMSE"),
        F.max(F.when(F.col("model") == "Naive baseline (vol_5)", F.col("RMSE"))).alias("baseline_RMSE"),
    ).select(
        "*",
        F.round(metrics_mod.improvement(F.col("baseline_RMSE"), F.col("best_RMSE")), 1).alias("improvement_pct"),
    )


# ---- publication and serving --------------------------------------------------

def q_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.dashboard(clean_panel(spark, sf_dir))


def q_dashboard_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(publish.dashboard_mae(publish.dashboard(clean_panel(spark, sf_dir))), ["mae", "mean_abs_error"])


def q_latest_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.latest_table(publish.dashboard(clean_panel(spark, sf_dir)))


def q_final_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    coefs = linear.fit(stored_clean(spark, sf_dir), V1, TARGET)
    return rounded(coefs.drop("_all"), [f"b{i}" for i in range(len(V1))] + ["intercept"])


def q_forecast_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = panels.supplier_day(spark, sf_dir)
    as_of = _last_day(spark, sf_dir)  # one date column, no bars
    return publish.forecast_latest(prices, final_model(spark, sf_dir), as_of=as_of, months=6)


def _last_day(spark: SparkSession, sf_dir: str):
    return panels.table(spark, sf_dir, "lineitem").agg(F.max(F.to_date("l_shipdate"))).first()[0]


def q_forecast_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest forecasts in descending order, with their rank (equal forecasts share it)."""
    from pyspark.sql import Window

    fc = publish.rank_forecasts(write_once(q_forecast_latest(spark, sf_dir), "forecasts"))
    # equal-valued forecasts are counted first: the window runs over distinct published values only
    per_value = fc.groupBy("pred_annual_%").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(F.col("pred_annual_%").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_value.select("pred_annual_%", (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).cast("long").alias("rank"))
    return fc.join(ranks, "pred_annual_%").select("rank", "ticker", "pred_annual_%")


def q_request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of a requested universe that holds tickers without bars."""
    sup = panels.table(spark, sf_dir, "supplier").select(panels.supplier_ticker(F.col("s_suppkey")).alias("ticker"))
    cust = panels.table(spark, sf_dir, "customer").select(panels.supplier_ticker(F.col("c_custkey")).alias("ticker"))
    return publish.request_status(sup.union(cust), panels.supplier_day(spark, sf_dir), _last_day(spark, sf_dir))


def q_walk_forward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold scores behind the linear board, one row per feature set and fold."""
    folded = board_panel(spark, sf_dir)
    return rounded(evaluate.linear_fold_scores(folded, FEATURE_SETS, with_naive=True), ["RMSE"])


def q_split_log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.split_two_log_scored(stored_clean(spark, sf_dir)), METRIC_COLS)


def q_export_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Self-check of the exported model: its prediction for the fixed demo request."""
    from volpanel.functions.scalar import annualise
    from volpanel.schemas import DEMO_REQUEST

    pred = serve.check_export(final_model(spark, sf_dir), DEMO_REQUEST)
    return pred.select(F.round("pred", 6).alias("pred_daily_vol"), F.round(annualise(F.col("pred")), 1).alias("pred_annual_pct"))


def q_score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = reuse(feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks"))
    req = serve.requests_from_features(features, V1)
    model = serve.model_row(linear.fit(feat.clean_v1(features), V1, TARGET), V1)
    out = serve.score_requests(req, model)
    return out.select("date", "ticker", "statusCode", "pred_daily_vol", "pred_annual_pct", "error")


# ---- tree candidates and selection (rows-only checks) ---------------------------

FORESTS, BOOSTED = ["RF depth=4", "RF depth=8"], ["GBT depth=3", "GBT depth=5"]
CANDIDATES = ["Linear", *FORESTS, *BOOSTED]


def q_walk_forward_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.assign_folds(v3_panel(spark, sf_dir))
    return evaluate.walk_forward_board(folded, FEATURE_SETS, FORESTS).drop("fold_RMSEs")


def q_walk_forward_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.assign_folds(v3_panel(spark, sf_dir))
    return evaluate.walk_forward_board(folded, FEATURE_SETS, BOOSTED).drop("fold_RMSEs")


def q_select_on_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.select_on_validation(v3_panel(spark, sf_dir), FEATURE_SETS, CANDIDATES)


def q_select_on_validation_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection on features_v2 with the original and enriched sets, boosted trees included."""
    sets = {"v1 (original)": V1, "v2 (enriched)": V2}
    return evaluate.select_on_validation(v2_panel(spark, sf_dir), sets, CANDIDATES)


def q_benchmark_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.benchmark_split(clean_panel(spark, sf_dir))


def q_benchmark_split_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.benchmark_split(clean_panel(spark, sf_dir), log_target=True)


# ---- GARCH ----------------------------------------------------------------------

def _garch_split(spark: SparkSession, sf_dir: str):
    clean = stored_clean(spark, sf_dir)
    cut = splits.cutoff_dates(clean, [1.0 - 0.2])
    j = with_row(clean, cut).withColumn("is_train", F.col("date") < F.col("c0")).drop("c0")
    return j.where("is_train"), j.where(~F.col("is_train"))


def q_garch_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _garch_split(spark, sf_dir)
    g = garch.garch_grid(train)
    return g.select(
        "ticker", "alpha", "beta", F.round("omega", 6).alias("omega"), F.round("loglik", 4).alias("loglik"),
        F.round("garch_vol", 6).alias("garch_vol"),
    )


def q_garch_split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single 80/20 split: GARCH(1,1) grid forecast, one constant per ticker over its test rows."""
    train, test = _garch_split(spark, sf_dir)
    fc = garch.garch_grid(train).select("ticker", F.col("garch_vol").alias("pred"))
    scored = test.join(fc, "ticker", "left")  # rows of tickers without a forecast are counted as unscored
    return rounded(metrics_mod.metrics(scored, TARGET, "pred", unscored=True).withColumn("model", F.lit("GARCH(1,1)")), METRIC_COLS)


def q_garch_split_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of ``garch_split_metrics`` with and without a forecast (too few or constant training returns)."""
    train, test = _garch_split(spark, sf_dir)
    fc = garch.garch_grid(train).select("ticker", F.col("garch_vol").alias("pred"))
    return metrics_mod.metrics(test.join(fc, "ticker", "left"), TARGET, "pred", unscored=True).select(
        "rows", "unscored", F.lit("GARCH(1,1)").alias("model")
    )


def q_garch_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-ω likelihood fit per ticker (NumPy per group); approximate, rows-only check."""
    train, _ = _garch_split(spark, sf_dir)
    return garch.garch_fit(train)


def q_score_requests_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request scoring of ``score_requests`` run as a Structured Streaming query."""
    from volpanel.streaming.scoring import score_through_stream

    features = reuse(feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks"))
    # date and ticker ride along in the request (extra keys are ignored by the scorer)
    req = features.select(F.to_json(F.struct("date", "ticker", *[F.col(f) for f in V1])).alias("request"))
    model = serve.model_row(linear.fit(feat.clean_v1(features), V1, TARGET), V1)
    out = score_through_stream(req, model)
    return out.select(
        F.get_json_object("request", "$.date").cast("date").alias("date"),
        F.get_json_object("request", "$.ticker").alias("ticker"),
        "statusCode", "pred_daily_vol", "pred_annual_pct", "error",
    )


# ---- profiles -----------------------------------------------------------------

def q_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panels.supplier_day(spark, sf_dir)
    return p.agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.count_distinct("ticker").cast("long").alias("tickers"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def q_model_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    from volpanel.sources.models import model_meta

    return model_meta(clean_panel(spark, sf_dir))


def q_market_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the v2 panel and how many of them found no market date (before any fill)."""
    v2 = write_once(v2_panel(spark, sf_dir).select("date"), "dates")
    m = market.market_features(market.market_for(v2, panels.market_day(spark, sf_dir)))
    j = v2.join(m.select("date", "vix"), "date", "left")
    return j.agg(F.count(F.lit(1)).cast("long").alias("rows"), F.count_if(F.col("vix").isNull()).cast("long").alias("missing"))


def q_missing_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested universe (the numbers of every supplier and customer) minus the tickers that have bars."""
    sup = panels.table(spark, sf_dir, "supplier").select(panels.supplier_ticker(F.col("s_suppkey")).alias("ticker"))
    cust = panels.table(spark, sf_dir, "customer").select(panels.supplier_ticker(F.col("c_custkey")).alias("ticker"))
    return publish.missing_tickers(sup.union(cust).distinct(), panels.supplier_day(spark, sf_dir))


def q_prices_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag-day bars pivoted to the wide quote layout and stacked back to long rows."""
    wide = files.to_wide(panels.flag_day(spark, sf_dir))
    return files.to_long(wide, files.wide_tickers(wide))


# ---- quantiles, selection and fills without the calendar's bound -----------------------

QUANTILES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


def q_quantile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch quantiles of the v2 features, weighted by volume, held against their exact ranks.

    ``rank_held``: the weight below the sketch's value is at most q plus the stated error of the total, the
    weight up to it at least q less that error.  ``bounded``: the merged sketch has at most 2 * SIZE points."""
    rows = feat.add_features_v2(panels.supplier_day(spark, sf_dir), keep=["volume"])
    rows = write_once(rows.select("ticker", "date", "volume", *V2), "weighted")
    n_blocks = sk.block_count(rows.count(), SKETCH_BLOCK)
    points = write_once(sk.sketch(rows, [], V2, F.struct("ticker", "date"), n_blocks, F.col("volume")), "sketch")
    error = sk.sketch_levels(n_blocks) / sk.SIZE
    asked = sk.sketch_quantiles(points, [], QUANTILES)
    size = points.groupBy("feature").agg(F.count(F.lit(1)).alias("points"))
    # exact ranks: one aggregate over the rows, each with its few sketch values
    wanted = asked.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("q", "value"))).alias("w"))
    wanted = wanted.agg(F.map_from_entries(F.collect_list(F.struct("feature", "w"))).alias("wanted"))  # one row: features x quantiles
    long = rows.select("volume", F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in V2])))
    long = with_row(long, wanted).select("feature", "x", "volume", F.inline(F.col("wanted")[F.col("feature")]))
    ranks = long.groupBy("feature", "q").agg(
        F.sum("volume").alias("total"), F.sum(F.when(F.col("x") < F.col("value"), F.col("volume")).otherwise(0.0)).alias("below"), F.sum(F.when(F.col("x") <= F.col("value"), F.col("volume")).otherwise(0.0)).alias("up_to"))
    held = (F.col("below") <= (F.col("q") + error) * F.col("total")) & (F.col("up_to") >= (F.col("q") - error) * F.col("total"))
    return ranks.join(size, "feature").select("feature", "q", "total", held.alias("rank_held"), (F.col("points") <= 2 * sk.SIZE).alias("bounded"))


SKETCH_BLOCK = 4096  # rows of a sketched block of this query: several blocks, so merged sketches, at every size


def q_tick_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-weighted 60 % and 80 % cutoffs of the tick panel's timestamps."""
    return splits.cutoff_values(panels.user_ticks(spark, sf_dir), [0.60, 0.80], "date")


def q_tick_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds of the tick panel by its distinct timestamps."""
    return splits.fold_profile(splits.assign_folds_by_value(panels.user_ticks(spark, sf_dir)))


def q_tick_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last purchase value known at every event of its user, and the last error's."""
    ev = panels.table(spark, sf_dir, "events")
    seen = [F.when(F.col("event_type") == kind, F.col("value")).alias(name) for kind, name in (("purchase", "last_purchase"), ("error", "last_error"))]
    rows = ev.select("event_id", F.format_string("U%d", F.col("user_id")).alias("ticker"), F.col("ts").alias("date"), *seen)
    return market.ffill_blocked(rows, ["last_purchase", "last_error"])


def q_score_request_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of every shape, by the day: flat, under ``features``, as ``body`` text, as a ``body`` object with ``features``, and
    flat with text behind the object (rejected)."""
    features = feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks")
    req = serve.requests_from_features(features, V1)
    shape, text = F.pmod(F.unix_date("date"), F.lit(5)), F.col("request")
    quoted = F.to_json(F.struct(text.alias("body")))
    shaped = F.when(shape == 0, text).when(shape == 1, F.concat(F.lit('{"features":'), text, F.lit("}"))).when(shape == 2, quoted)
    shaped = shaped.when(shape == 3, F.concat(F.lit('{"body":{"features":'), text, F.lit("}}"))).otherwise(F.concat(text, F.lit(',"ret":1')))
    out = serve.score_requests(req.withColumn("request", shaped), final_model(spark, sf_dir))
    return out.select("date", "ticker", "statusCode", "pred_daily_vol", "pred_annual_pct", "error")


# ---- sources, sinks and versions ---------------------------------------------------------

def _price_files(spark: SparkSession, sf_dir: str) -> str:
    """Flag-day bars as CSV text files, with faults on some days of the month (7: text for a number, 11: no date, 13: a field
    less, 17: no ticker, 19: an empty number, which is none)."""
    day = F.dayofmonth("date")
    value = {c: F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")}
    fields = [
        F.when(day == 11, F.lit("2024-99-01")).otherwise(F.col("date").cast("string")), F.when(day == 17, F.lit("")).otherwise(F.col("ticker")),
        value["open"], value["high"], value["low"], F.when(day == 19, F.lit("")).otherwise(value["close"]), F.when(day == 7, F.lit("n/a")).otherwise(value["volume"])]
    line = F.when(day == 13, F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields]))
    path = write_path(spark, "price-lines")
    panels.flag_day(spark, sf_dir).select(line.alias("value")).write.text(path)
    spark.createDataFrame([("Date,Ticker,Open,High,Low,Close,Volume",)], "value string").coalesce(1).write.mode("append").text(path)
    return path


def q_price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of every line of those files: a bar, or rejected for a reason."""
    bars, rejected = files.read_price_lines(spark, _price_files(spark, sf_dir))
    bars = files.guarded(bars)
    good = bars.select(F.lit("bar").alias("outcome"), F.col("volume"), F.col("close").isNull().cast("long").alias("no_close"))
    bad = rejected.select(F.col("reason").alias("outcome"), F.lit(None).cast("double").alias("volume"), F.lit(0).cast("long").alias("no_close"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"), F.sum("volume").alias("volume"), F.sum("no_close").alias("no_close"))


def q_features_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table published twice, first without its fill of features; readers see the second version."""
    path = write_path(spark, "features-table")
    panel = write_once(files.guarded(feat.add_features(panels.supplier_day(spark, sf_dir), method="blocks")), "features")
    versions.publish(feat.clean_v1(panel).where(F.col("vol_5") < 0), path, note="empty")
    versions.publish(rounded(feat.clean_v1(panel), R6_V1), path, note="all")
    number = versions.current(spark, path)["number"]
    return versions.read(spark, path).withColumn("version", F.lit(number).cast("long"))


def q_score_model_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests through a stream whose model is replaced half-way: a fixed model until the middle date, the final one from there."""
    from volpanel.streaming.scoring import score_with_versions

    features = stored_clean(spark, sf_dir)
    req = write_once(features.select("date", F.to_json(F.struct("date", "ticker", *[F.col(f) for f in V1])).alias("request")), "requests")
    middle = splits.cutoff_dates(req, [0.5])
    dated = with_row(req, middle)
    fixed = spark.createDataFrame([(0.1, 0.2, 0.3, 0.4, 0.001)], "b0 double, b1 double, b2 double, b3 double, intercept double")
    out = score_with_versions([dated.where(F.col("date") < F.col("c0")), dated.where(F.col("date") >= F.col("c0"))], [serve.model_row(fixed, V1), serve.model_row(linear.fit(features, V1, TARGET), V1)])
    field = lambda c, kind: F.get_json_object("request", f"$.{c}").cast(kind).alias(c)
    return out.select(field("date", "date"), field("ticker", "string"), "model_version", "statusCode", "pred_daily_vol")


def q_refit_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear model as of each quarter's last day, from a table of day statistics that was built in three deliveries."""
    clean = stored_clean(spark, sf_dir)
    path = write_path(spark, "day-statistics")
    cut = with_row(clean, splits.cutoff_dates(clean, [0.4, 0.7]))
    increments.start(cut.where("date < c0"), V1, TARGET, path)
    increments.add_days(spark, path, cut.where("date >= c0 and date < c1"), V1, TARGET)
    increments.add_days(spark, path, cut.where("date >= c1"), V1, TARGET)
    stats = versions.read(spark, path)
    ends = stats.groupBy(F.year("date").alias("y"), F.quarter("date").alias("q")).agg(F.max("date").alias("date"))
    return rounded(increments.refit_each(stats, len(V1), ends), [f"b{i}" for i in range(len(V1))] + ["intercept"])


def q_portable_forest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest shipped as node arrays: the test rows' answers to JSON requests against the fitted model's own predictions."""
    from volpanel.operators import portable, trees

    clean = stored_clean(spark, sf_dir)
    j = with_row(clean, splits.cutoff_dates(clean, [0.8]))
    test = j.where("date >= c0").drop("c0")
    model = trees.fit_model(j.where("date < c0"), V1, trees.wide_forest(30, 6))
    answers = serve.score_requests(serve.requests_from_features(test, V1), portable.from_model(model, V1))
    own = model.transform(test).select("date", "ticker", F.round("pred", 6).alias("own"))
    both = answers.join(own, ["date", "ticker"])
    off = (F.col("statusCode") != 200) | (F.abs(F.col("pred_daily_vol") - F.col("own")) > 1.5e-6) | F.col("pred_daily_vol").isNull()
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(off).alias("differing"))


def q_tick_garch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GARCH(1,1) likelihood of every user's tick returns, in pieces of 20 returns (most users span several)."""
    ticks = feat.add_features_blocked(panels.user_ticks(spark, sf_dir))
    got = garch.loglik_in_pieces(ticks, 0.1, 0.85, rows_per_piece=20)
    return got.select("ticker", "n", F.round(F.ln("vbar"), 6).alias("ln_vbar"), F.round(F.ln("s2"), 6).alias("ln_s2"), F.round("loglik", 6).alias("loglik"))


def q_split_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundle metadata of the 60/20/20 split: what train and validation hold, and both boundary dates."""
    from volpanel.sources.models import split_meta

    clean = stored_clean(spark, sf_dir)
    return split_meta(clean, splits.cutoff_dates(clean, [0.60, 0.80]))


def q_ticker_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ticker with its bars' number and dates."""
    return panels.supplier_day(spark, sf_dir).groupBy("ticker").agg(F.count(F.lit(1)).alias("bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


REGISTRY = {
    "split_meta": q_split_meta,
    "ticker_list": q_ticker_list,
    "tick_garch": q_tick_garch,
    "portable_forest_check": q_portable_forest_check,
    "refit_by_quarter": q_refit_by_quarter,
    "price_lines": q_price_lines,
    "features_versions": q_features_versions,
    "score_model_swap": q_score_model_swap,
    "quantile_sketch": q_quantile_sketch,
    "tick_cutoffs": q_tick_cutoffs,
    "tick_folds": q_tick_folds,
    "tick_fill": q_tick_fill,
    "score_request_shapes": q_score_request_shapes,
    "features_clean": q_features_clean,
    "preview_clean": q_preview_clean,
    "features": q_features,
    "features_v2": q_features_v2,
    "features_v2_flag": q_features_v2_flag,
    "returns": q_returns,
    "rolling_vol_sumsq": q_rolling_vol_sumsq,
    "forward_target": q_forward_target,
    "range_features": q_range_features,
    "parkinson": q_parkinson,
    "volume_ratio": q_volume_ratio,
    "tick_features": q_tick_features,
    "tick_features_blocks": q_tick_features_blocks,
    "market_features": q_market_features,
    "features_v3_calendar": _v3("calendar"),
    "features_v3_ticker": _v3("ticker"),
    "features_v3_panel": _v3("panel"),
    "cutoffs": q_cutoffs,
    "split_two_profile": q_split_two_profile,
    "split_three_profile": q_split_three_profile,
    "fold_calendar": q_fold_calendar,
    "fold_profile": q_fold_profile,
    "fold_profile_v3": q_fold_profile_v3,
    "naive_walk_forward": q_naive_walk_forward,
    "walk_forward_linear": q_walk_forward_linear,
    "walk_forward_linear_purged": q_walk_forward_linear_purged,
    "walk_forward_linear_v2": q_walk_forward_linear_v2,
    "walk_forward_board": q_walk_forward_board,
    "walk_forward_winner": q_walk_forward_winner,
    "walk_forward_predictions": q_walk_forward_predictions,
    "documented_metrics": q_documented_metrics,
    "naive_metrics": q_naive_metrics,
    "split_two_metrics": q_split_two_metrics,
    "split_two_best": q_split_two_best,
    "dashboard": q_dashboard,
    "dashboard_mae": q_dashboard_mae,
    "latest_flag": q_latest_flag,
    "forecast_latest": q_forecast_latest,
    "forecast_ranked": q_forecast_ranked,
    "request_status": q_request_status,
    "walk_forward_scores": q_walk_forward_scores,
    "split_log_metrics": q_split_log_metrics,
    "final_model": q_final_model,
    "export_check": q_export_check,
    "score_requests": q_score_requests,
    "score_requests_stream": q_score_requests_stream,
    "garch_grid": q_garch_grid,
    "garch_split_metrics": q_garch_split_metrics,
    "garch_split_coverage": q_garch_split_coverage,
    "garch_forecast": q_garch_forecast,
    "walk_forward_forest": q_walk_forward_forest,
    "walk_forward_gbt": q_walk_forward_gbt,
    "select_on_validation": q_select_on_validation,
    "select_on_validation_v2": q_select_on_validation_v2,
    "benchmark_split": q_benchmark_split,
    "benchmark_split_log": q_benchmark_split_log,
    "profile": q_profile,
    "missing_tickers": q_missing_tickers,
    "model_meta": q_model_meta,
    "market_misses": q_market_misses,
    "prices_long": q_prices_long,
}
