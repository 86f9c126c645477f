"""Model bundle sink and source: the one-row model plus its metadata, as JSON.

The bundle directory holds ``model/`` (the portable linear model: features, coef,
intercept, horizon, log_space, documented metrics) and ``meta/`` (target, row count,
ticker count, date range, note).  The list of training tickers is written as its own
table ``tickers/`` rather than inlined into the metadata row, so the row stays small
however many tickers the panel has.  Paths are Hadoop paths (local, HDFS, object
stores); loading tries locations in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volpanel.functions.rows import with_row
from volpanel.schemas import LINEAR_MODEL, TARGET, V1

META_NOTE = "Forecast: standard deviation of the next five daily returns."


def split_meta(df: DataFrame, cutoffs: DataFrame, target: str = TARGET, note: str = META_NOTE) -> DataFrame:
    """``model_meta`` of the rows before the last cutoff, with the cutoffs (``c0``, ``c1``, ... of ``splits.cutoff_dates``) as
    ``boundary_0``, ``boundary_1``, ...: what a model chosen on a chronological split was trained on."""
    names = [c for c in cutoffs.columns if c.startswith("c")]
    train = with_row(df, cutoffs).where(F.col("date") < F.col(names[-1])).drop(*names)
    meta = model_meta(train, target, note).withColumn("trained_on", F.lit("rows before the last boundary"))
    return with_row(meta, cutoffs.select(*[F.date_format(c, "yyyy-MM-dd").alias(f"boundary_{i}") for i, c in enumerate(names)]))


def model_meta(df: DataFrame, target: str = TARGET, note: str = META_NOTE) -> DataFrame:
    """One-row training metadata: rows, tickers, first and last date (one aggregate)."""
    return df.agg(
        F.lit(target).alias("target"),
        F.lit("all rows").alias("trained_on"),
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count_distinct("ticker").cast("long").alias("n_tickers"),
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("last_date"),
        F.lit(note).alias("note"),
    )


def save_model(model: DataFrame, meta: DataFrame, path: str, tickers: DataFrame | None = None) -> None:
    model.coalesce(1).write.mode("overwrite").json(f"{path}/model")
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    if tickers is not None:
        tickers.select("ticker").distinct().write.mode("overwrite").parquet(f"{path}/tickers")


def load_model(spark: SparkSession, paths: str | list[str], default_features: list[str] = V1) -> DataFrame:
    """The model row from the first readable location; a missing feature list takes the default."""
    from pyspark.errors import AnalysisException

    tried = []
    for p in [paths] if isinstance(paths, str) else paths:
        try:
            m = spark.read.schema(LINEAR_MODEL).json(f"{p}/model")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            tried.append(p)
            continue
        if m.isEmpty():
            tried.append(p)
            continue
        return m.withColumn("features", F.coalesce(F.col("features"), F.array(*[F.lit(f) for f in default_features])))
    raise FileNotFoundError("no model bundle found in " + ", ".join(tried))


# ---- fitted Spark ML models (forests, boosted trees) ---------------------------------

def save_ml(model, meta: DataFrame, path: str, feats: list[str], log_target: bool = False, cutoff: str | None = None, partitions: int | None = None) -> None:
    """Bundle of a fitted Spark ML model: the model in Spark's format and one metadata row (its features
    in order, whether it learned the log target, the cutoff date of its training rows, its sampling layout)."""
    model.write().overwrite().save(f"{path}/ml")
    row = meta.select(
        "*", F.lit(type(model).__name__).alias("kind"), F.array(*[F.lit(f) for f in feats]).alias("features"), F.lit(log_target).alias("log_space"),
        F.lit(cutoff).cast("string").alias("cutoff_date"), F.lit(partitions).cast("int").alias("partitions"),
    )
    row.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_ml(spark: SparkSession, path: str):
    """(model, metadata row) of ``save_ml``."""
    from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel

    kinds = {k.__name__: k for k in (GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel)}
    meta = spark.read.json(f"{path}/meta").first()
    return kinds[meta["kind"]].load(f"{path}/ml"), meta


def predict_ml(df: DataFrame, bundle: tuple) -> DataFrame:
    """``df`` with ``pred`` of a loaded bundle."""
    from volpanel.functions.scalar import from_log
    from volpanel.operators.trees import VEC

    from pyspark.ml.feature import VectorAssembler

    model, meta = bundle
    out = model.transform(VectorAssembler(inputCols=list(meta["features"]), outputCol=VEC, handleInvalid="error").transform(df)).drop(VEC)
    return out.withColumn("pred", from_log(F.col("pred"))) if meta["log_space"] else out


def load_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(f"{path}/meta")
