"""Evaluation jobs: naive baseline, walk-forward linear, single and three-way splits.

Linear candidates are fitted for every fold in one aggregation pass (sufficient
statistics per fold + prefix sums), so the walk-forward costs one scan of the panel
rather than one per fold.  Tree candidates of the grids come from the histogram learner
(``volpanel.operators.hist_trees``), those of the single splits from Spark ML (``volpanel.operators.trees``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volpanel.operators import hist_trees, linear, metrics
from volpanel.operators.splits import assign_folds, cutoff_dates, label_set
from volpanel.schemas import BASELINE, N_FOLDS, TARGET, V1
from volpanel.session import write_once
from volpanel.functions.rows import with_row


def naive(df: DataFrame, out: str = "pred") -> DataFrame:
    """Naive forecast: the next five days look like the last five (pred = vol_5)."""
    return df.withColumn(out, F.col(BASELINE))


def naive_walk_forward(folded: DataFrame) -> DataFrame:
    """Per out-of-sample fold: rows, RMSE, MAE, R² of the naive forecast."""
    scored = naive(folded.where(F.col("fold") >= 1))
    return metrics.metrics(scored, TARGET, "pred", ["fold"])


def linear_walk_forward(folded: DataFrame, feats: list[str] = V1, include_first: bool = False, purge: bool = False) -> DataFrame:
    """Rows of the scored folds with ``pred`` from a model fitted on earlier folds.

    ``include_first`` also scores fold 0 with its own in-sample fit (dashboard).
    ``purge`` drops training rows whose target window reaches into the test fold
    (needs ``train_fold`` from ``assign_folds(..., purge_col="target_end")``); by
    default, as in the source, the last rows before a test fold keep their overlapping
    targets.
    """
    coefs = linear.fit_walk_forward(folded, feats, TARGET, include_first, purge)
    return linear.predict(folded, coefs, feats, ["fold"])


def walk_forward_metrics(folded: DataFrame, feats: list[str] = V1, purge: bool = False) -> DataFrame:
    """Per out-of-sample fold: rows, RMSE, MAE, R² of the walk-forward linear model."""
    return metrics.metrics(linear_walk_forward(folded, feats, purge=purge), TARGET, "pred", ["fold"])


def linear_board(folded: DataFrame, sets: dict[str, list[str]], with_naive: bool = False) -> DataFrame:
    """Scoreboard rows (features, model, mean_RMSE, std_RMSE, fold_RMSEs) for linear candidates."""
    return metrics.summarise_folds(linear_fold_scores(folded, sets, with_naive), ["features", "model"])


def linear_fold_scores(folded: DataFrame, sets: dict[str, list[str]], with_naive: bool = False) -> DataFrame:
    """(fold, features, model, RMSE) of every linear candidate and out-of-sample fold.

    All candidates share one statistics pass over the union of their features, one
    broadcast of the coefficient rows (one per fold), one projection holding every
    candidate's prediction and one error aggregation per fold, which also scores the
    naive forecast when asked.
    """
    from volpanel.functions.scalar import dot

    coefs = linear.fit_walk_forward_sets(folded, sets, TARGET)
    scored = folded.join(F.broadcast(coefs), "fold")
    y = F.col(TARGET)
    errs, rows = [], []
    for t, (name, feats) in enumerate(sets.items()):
        pred = dot([F.col(f"c{t}_b{i}") for i in range(len(feats))], [F.col(f) for f in feats], F.col(f"c{t}_intercept"))
        errs.append(F.sqrt(F.avg((pred - y) * (pred - y))).alias(f"r{t}"))
        rows.append((name, "Linear", f"r{t}"))
    if with_naive:
        base = F.col(BASELINE)
        errs.append(F.sqrt(F.avg((base - y) * (base - y))).alias("r_naive"))
        rows.append((BASELINE, "Naive", "r_naive"))
    per_fold = scored.groupBy("fold").agg(*errs)
    return per_fold.select(
        "fold",
        F.inline(F.array(*[F.struct(F.lit(f).alias("features"), F.lit(m).alias("model"), F.col(c).alias("RMSE")) for f, m, c in rows])),
    )


def documented_metrics(clean: DataFrame, feats: list[str] = V1, n_folds: int = N_FOLDS) -> DataFrame:
    """The shipped model's documented walk-forward record (one row).

    Means of the fold scores (RMSE, MAE, R²), the population std of the fold RMSEs,
    the naive baseline's mean RMSE and the improvement, computed from the rounded
    figures as documented.
    """
    folded = assign_folds(clean, n_folds)
    lin = walk_forward_metrics(folded, feats)
    base = naive_walk_forward(folded).select("fold", F.col("RMSE").alias("base_RMSE"))
    j = lin.join(base, "fold")
    rec = j.agg(
        F.round(F.avg("RMSE"), 6).alias("test_RMSE"),
        F.round(F.stddev_pop("RMSE"), 6).alias("test_RMSE_std"),
        F.round(F.avg("MAE"), 6).alias("test_MAE"),
        F.round(F.avg("R2"), 4).alias("test_R2"),
        F.round(F.avg("base_RMSE"), 6).alias("baseline_RMSE"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "RMSE"))), lambda s: F.round(s["RMSE"], 6)).alias(
            "fold_RMSEs"
        ),
    )
    return rec.select(
        F.lit(f"walk-forward, {n_folds - 1} out-of-sample folds").alias("method"),
        "*",
        F.round(metrics.improvement(F.col("baseline_RMSE"), F.col("test_RMSE")), 1).alias("improvement_vs_baseline_%"),
    )


def walk_forward_predictions(clean: DataFrame, feats: list[str] = V1, n_folds: int = N_FOLDS) -> DataFrame:
    """Every row with a prediction: folds ≥ 1 out-of-sample, fold 0 in-sample."""
    folded = assign_folds(clean, n_folds)
    scored = linear_walk_forward(folded, feats, include_first=True)
    return scored.withColumn("set", label_set(F.col("fold")))


def split_two_scored(df: DataFrame, feats: list[str] = V1, test_frac: float = 0.20) -> DataFrame:
    """Single chronological split: naive and linear metrics on the test rows."""
    cut = cutoff_dates(df, [1.0 - test_frac])
    j = with_row(df, cut).withColumn("is_train", F.col("date") < F.col("c0")).drop("c0")
    coefs = linear.fit(j.where("is_train"), feats, TARGET)
    test = j.where(~F.col("is_train"))
    lin = linear.predict(test.withColumn("_all", F.lit(0)), coefs, feats, ["_all"])
    m_lin = metrics.metrics(lin, TARGET, "pred").withColumn("model", F.lit("Linear regression"))
    m_base = metrics.metrics(naive(test), TARGET, "pred").withColumn("model", F.lit("Naive baseline (vol_5)"))
    return m_base.unionByName(m_lin)


def split_two_log_scored(df: DataFrame, feats: list[str] = V1, test_frac: float = 0.20) -> DataFrame:
    """Single chronological split: naive, and the linear model that learns ln(y + ε) and predicts exp(·)."""
    from volpanel.functions.scalar import from_log, to_log

    j = with_row(df, cutoff_dates(df, [1.0 - test_frac])).withColumn("is_train", F.col("date") < F.col("c0")).drop("c0")
    coefs = linear.fit(j.where("is_train").withColumn("_ly", to_log(F.col(TARGET))), feats, "_ly")
    test = j.where(~F.col("is_train"))
    lin = linear.predict(test.withColumn("_all", F.lit(0)), coefs, feats, ["_all"]).withColumn("pred", from_log(F.col("pred")))
    boards = [metrics.metrics(naive(test), TARGET, "pred").withColumn("model", F.lit("Naive baseline (vol_5)"))]
    boards.append(metrics.metrics(lin, TARGET, "pred").withColumn("model", F.lit("Log-linear regression")))
    return boards[0].unionByName(boards[1])


# ---- tree candidates, selection and single-split benchmarks ----------------------

# the grids' tree models; the values are fixed by the source's grids
TREE_MODELS = {
    "RF depth=4": hist_trees.Forest(300, 4),
    "RF depth=8": hist_trees.Forest(300, 8),
    "GBT depth=3": hist_trees.Boosted(300, 3),
    "GBT depth=5": hist_trees.Boosted(300, 5),
}


def walk_forward_board(folded: DataFrame, sets: dict[str, list[str]], models: list[str]) -> DataFrame:
    """Scoreboard over feature sets x models: mean / population std of the fold RMSEs.

    Linear candidates come from one pass of sufficient statistics, all tree candidates from one histogram learner
    over one stored matrix.
    """
    boards = []
    if "Linear" in models:
        boards.append(linear_board(folded, sets))
    if trees := {m: TREE_MODELS[m] for m in models if m != "Linear"}:
        last = folded.agg(F.max("fold")).first()[0] or 0
        pred = hist_trees.predictions(folded, sets, trees, TARGET, "fold", list(range(1, last + 1)), ["ticker", "date"])
        per_fold = metrics.metrics(pred.withColumnRenamed("seg", "fold"), "y", "pred", ["features", "model", "fold"])
        boards.append(metrics.summarise_folds(per_fold, ["features", "model"]))
    out = boards[0]
    for b in boards[1:]:
        out = out.unionByName(b)
    return out


def _split_frames(df: DataFrame, qs: list[float]):
    cut = cutoff_dates(df, qs)
    return with_row(df, cut)


def benchmark_split(clean: DataFrame, feats: list[str] = V1, test_frac: float = 0.20, log_target: bool = False) -> DataFrame:
    """Single chronological split scoreboard: naive, linear, forest (200 trees, depth 6), GARCH(1,1).

    With ``log_target`` the linear and forest models learn ln(y + 1e-6) and predict
    exp(·); scores are always in volatility units.
    """
    from volpanel.operators import garch, trees

    clean = write_once(clean.select("date", "ticker", *dict.fromkeys(["ret", *feats, BASELINE, TARGET])), "clean")
    j = _split_frames(clean, [1.0 - test_frac]).withColumn("is_train", F.col("date") < F.col("c0")).drop("c0")
    train, test = j.where("is_train"), j.where(~F.col("is_train"))
    lin = trees.fit_predict(train, test, feats, trees.linear_ml(), log_target)
    rf = trees.fit_predict(train, test, feats, trees.wide_forest(200, 6), log_target)
    fc = garch.garch_fit(train).select("ticker", F.col("garch_vol").alias("pred"))
    # every model is scored on the same test rows; ``unscored`` counts those without a forecast
    boards = [
        metrics.metrics(naive(test), TARGET, "pred", unscored=True).withColumn("model", F.lit("Naive baseline (vol_5)")),
        metrics.metrics(lin, TARGET, "pred", unscored=True).withColumn("model", F.lit("Linear regression")),
        metrics.metrics(rf, TARGET, "pred", unscored=True).withColumn("model", F.lit("Random forest")),
        metrics.metrics(test.join(fc, "ticker", "left"), TARGET, "pred", unscored=True).withColumn("model", F.lit("GARCH(1,1)")),
    ]
    out = boards[0]
    for b in boards[1:]:
        out = out.unionByName(b)
    # scores are compared as published: rounded to 6 places
    out = write_once(out.select("rows", *[F.round(c, 6).alias(c) for c in ("RMSE", "MAE", "R2")], "unscored", "model"), "board")
    return with_row(out, out.agg(F.max(F.when(F.col("model") == "Naive baseline (vol_5)", F.col("RMSE"))).alias("_base"))).select(
        "*", F.round(metrics.improvement(F.col("_base"), F.col("RMSE")), 1).alias("improvement_pct")
    ).drop("_base")


def choose_model(board: DataFrame) -> DataFrame:
    """The model to ship: the best by RMSE, but linear when the baseline or GARCH wins."""
    best = metrics.best(board, "RMSE", ["model"])
    return best.select(
        F.when(F.col("model").isin("Linear regression", "Random forest"), F.col("model"))
        .otherwise(F.lit("Linear regression"))
        .alias("shipped"),
        F.col("model").alias("best"),
    )


def ship_chosen(clean: DataFrame, feats: list[str] = V1, test_frac: float = 0.20, log_target: bool = False) -> tuple[DataFrame, DataFrame]:
    """(choice, model): the single-split benchmark's choice and that model, fitted on its training rows, as the one row that
    request scoring takes: linear coefficients, or the forest as node arrays."""
    from volpanel.functions.scalar import to_log
    from volpanel.operators import portable, trees
    from volpanel.plans.serve import model_row

    choice = choose_model(benchmark_split(clean, feats, test_frac, log_target))
    shipped = choice.first()["shipped"]
    train = _split_frames(clean, [1.0 - test_frac]).where(F.col("date") < F.col("c0")).drop("c0")
    if shipped == "Random forest":
        return choice, portable.from_model(trees.fit_model(train, feats, trees.wide_forest(200, 6), log_target), feats, log_target)
    y = "_ly" if log_target else TARGET
    return choice, model_row(linear.fit(train.withColumn("_ly", to_log(F.col(TARGET))), feats, y), feats, log_space=log_target)


def select_on_validation(df: DataFrame, sets: dict[str, list[str]], models: list[str], qs=(0.60, 0.80)) -> DataFrame:
    """60/20/20: choose on validation, refit on train and validation, score the test set once.

    Rows: every candidate's validation RMSE (role ``val``), then the test scores of the
    naive baseline, the chosen model and the shipped linear v1 model (role ``test``).  Train, validation and test are segments
    0, 1 and 2, so a candidate is a walk-forward fit scored on segment 1, and the chosen one is fitted again for segment 2.
    """
    cut = _split_frames(write_once(df, "panel"), list(qs))  # read for the cutoffs and by every fit
    seg = F.when(F.col("date") < F.col("c0"), 0).when(F.col("date") < F.col("c1"), 1).otherwise(2)
    j = cut.withColumn("fold", seg).drop("c0", "c1")

    def scored(sets, models, upto):
        """(features, model, y, pred) of segment ``upto``, fitted on the segments before it."""
        parts = [linear_segment(j, upto, feats).select(F.lit(s).alias("features"), F.lit("Linear").alias("model"), F.col(TARGET).alias("y"), "pred") for s, feats in sets.items() if "Linear" in models]
        if trees := {m: TREE_MODELS[m] for m in models if m != "Linear"}:
            parts.append(hist_trees.predictions(j, sets, trees, TARGET, "fold", [upto], ["ticker", "date"]).select("features", "model", "y", "pred"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    val = write_once(metrics.metrics(scored(sets, models, 1), "y", "pred", ["features", "model"]).select(F.lit("val").alias("role"), "features", "model", "RMSE"), "validation")
    best = val.orderBy("RMSE", "features", "model").first()
    ws, wm = best["features"], best["model"]
    test = j.where("fold = 2")

    def row(scores, features, model):
        return scores.select(F.lit("test").alias("role"), F.lit(features).alias("features"), F.lit(model).alias("model"), "RMSE", "MAE", "R2")

    out = val.unionByName(row(metrics.metrics(naive(test), TARGET, "pred"), "vol_5", "Naive baseline (vol_5)"), allowMissingColumns=True)
    out = out.unionByName(row(metrics.metrics(scored({ws: sets[ws]}, [wm], 2), "y", "pred"), ws, f"Final model: {wm}"))
    return out.unionByName(row(metrics.metrics(linear_segment(j, 2, V1), TARGET, "pred"), "v1 (original)", "Linear v1 (shipped)"))


def linear_segment(segmented: DataFrame, upto: int, feats: list[str]) -> DataFrame:
    """Segment ``upto`` with ``pred`` of a linear model fitted on the segments before it."""
    coefs = linear.fit(segmented.where(F.col("fold") < upto), feats, TARGET)
    return linear.predict(segmented.where(F.col("fold") == upto).withColumn("_all", F.lit(0)), coefs, feats, ["_all"])


def fit_predict_any(train: DataFrame, test: DataFrame, feats: list[str], model: str) -> DataFrame:
    """``test`` with ``pred`` from one model fitted on ``train`` (linear via sufficient statistics, trees by Spark ML)."""
    from volpanel.operators import trees

    if model == "Linear":
        coefs = linear.fit(train, feats, TARGET)
        return linear.predict(test.withColumn("_all", F.lit(0)), coefs, feats, ["_all"])
    return trees.fit_predict(train, test, feats, trees.MODELS[model]())
