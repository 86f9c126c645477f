"""Portable linear model (JSON) and scoring of JSON requests, batch or stream.

A request is a JSON object: flat ``{"ret": .., "vol_5": .., ...}``, nested under
``"features"``, or carried as text (or an object) under ``"body"``.  The response is
``statusCode`` plus a body: 200 with ``pred_daily_vol`` (6 places) and
``pred_annual_pct`` (1 place), 400 ``missing features: [...]`` when a model feature
is absent (checked before any cast), 400 ``bad input`` when a value is null, not a
number, or the JSON is malformed.  Everything is built-in JSON/array expressions;
the one-row model is broadcast to the requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volpanel.functions.scalar import annualise, dot, to_double
from volpanel.operators.portable import TREE, nodes_of, tree_score
from volpanel.schemas import HORIZON, LINEAR_MODEL
from volpanel.functions.rows import with_row

STR_MAP = T.MapType(T.StringType(), T.StringType())


def model_row(coefs: DataFrame, feats: list[str], metrics: DataFrame | None = None, log_space: bool = False) -> DataFrame:
    """One-row portable model: features, coef, intercept, target_horizon_days, log_space, documented_metrics."""
    row = coefs.select(
        F.array(*[F.lit(f) for f in feats]).alias("features"),
        F.array(*[F.col(f"b{i}") for i in range(len(feats))]).alias("coef"),
        F.col("intercept"),
        F.lit(HORIZON).alias("target_horizon_days"),
        F.lit(log_space).alias("log_space"),
    )
    if metrics is not None:
        row = with_row(row, metrics.select(F.struct(*metrics.columns).alias("documented_metrics")))
    else:
        row = row.withColumn("documented_metrics", F.lit(None).cast(LINEAR_MODEL["documented_metrics"].dataType))
    return row


def export_linear(model: DataFrame, path: str) -> None:
    """Write the one-row model as a single JSON document."""
    model.coalesce(1).write.mode("overwrite").json(path)


TREE_MODEL = f"features array<string>, intercept double, depth int, kind string, log_space boolean, trees array<{TREE}>"


def read_trees(spark, path: str) -> DataFrame:
    """Read a portable tree model written by ``export_linear``."""
    return spark.read.schema(TREE_MODEL).json(path)


def read_linear(spark, path: str) -> DataFrame:
    """Read the portable model with its explicit schema (no inference)."""
    return spark.read.schema(LINEAR_MODEL).json(path)


WRAPPED = T.MapType(T.StringType(), STR_MAP)


def json_object(text: Column) -> Column:
    """The map of a text that is one whole JSON object, else NULL.

    The text is parsed once, as a value inside another object: what follows the object either breaks
    the outer one or adds a key to it, and the outer map must have one key."""
    whole = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), WRAPPED)
    return F.when(F.size(whole) == 1, whole["v"])


def unwrap_request(df: DataFrame, raw: str = "request", out: str = "_f") -> DataFrame:
    """Adds ``out``: map of feature name → raw value text (NULL when not a JSON object).

    Three staged projections (parse, unwrap ``body``, unwrap ``features``), so each
    JSON parse is evaluated once per row.
    """
    empty = F.create_map().cast(STR_MAP)
    df = df.withColumn("_ev", json_object(F.col(raw)))
    body_txt = F.col("_ev")["body"]
    df = df.withColumn(
        "_body",
        F.when(
            F.map_contains_key(F.col("_ev"), "body"),
            F.when(body_txt.isNull() | (F.trim(body_txt) == ""), empty).otherwise(json_object(body_txt)),
        ).otherwise(F.col("_ev")),
    )
    df = df.withColumn(
        out,
        F.when(F.map_contains_key(F.col("_body"), "features"), F.from_json(F.col("_body")["features"], STR_MAP)).otherwise(
            F.col("_body")
        ),
    )
    return df.drop("_ev", "_body")


def _py_list(names: Column) -> Column:
    """['a', 'b'] as Python prints a list of strings."""
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda s: F.concat(F.lit("'"), s, F.lit("'"))), ", "), F.lit("]"))


def score_requests(requests: DataFrame, model: DataFrame, request_col: str = "request") -> DataFrame:
    """Adds statusCode, pred_daily_vol, pred_annual_pct, error, body (JSON) to each request row.

    ``model`` is one row: a linear model, or trees as node arrays (``operators.portable``)."""
    trees = "trees" in model.columns
    m = model.select(
        F.col("features").alias("_mf"),
        F.col("depth" if trees else "coef").alias("_mc"),
        F.col("intercept").alias("_mi"),
        F.coalesce(F.col("log_space"), F.lit(False)).alias("_ml"),
    )
    j = unwrap_request(with_row(requests, m), request_col, "_f")
    missing = F.filter(F.col("_mf"), lambda f: ~F.coalesce(F.map_contains_key(F.col("_f"), f), F.lit(False)))
    xs = F.transform(F.col("_mf"), lambda f: to_double(F.col("_f")[f]))
    j = j.withColumn("_miss", missing).withColumn("_x", xs)
    bad = F.col("_f").isNull() | F.exists(F.col("_x"), lambda x: x.isNull())
    if trees:
        # the trees are named once, next to their subquery: as a column of the steps before they would be copied into every row
        j = with_row(j, model.select(nodes_of(F.col("trees")).alias("_nodes"))).withColumn("_raw", F.when(~bad, tree_score(F.col("_nodes"), F.col("_x"), F.col("_mi"), F.col("_mc")))).drop("_nodes")
        raw = F.col("_raw")
    else:
        raw = dot(F.col("_mc"), F.col("_x"), F.col("_mi"))
    daily = F.when(F.col("_ml"), F.exp(raw)).otherwise(raw)
    status = (
        F.when(F.col("_f").isNull(), F.lit(400))
        .when(F.size("_miss") > 0, F.lit(400))
        .when(bad, F.lit(400))
        .otherwise(F.lit(200))
    )
    error = (
        F.when(F.col("_f").isNull(), F.lit("bad input: request is not a JSON object"))
        .when(F.size("_miss") > 0, F.concat(F.lit("missing features: "), _py_list(F.col("_miss"))))
        .when(bad, F.lit("bad input: feature values must be numbers"))
    )
    ok = status == 200
    out = j.select(
        *requests.columns,
        status.alias("statusCode"),
        F.when(ok, F.round(daily, 6)).alias("pred_daily_vol"),
        F.when(ok, F.round(annualise(daily), 1)).alias("pred_annual_pct"),
        error.alias("error"),
    )
    body = F.when(
        F.col("statusCode") == 200,
        F.to_json(F.struct(F.col("pred_daily_vol"), F.col("pred_annual_pct"))),
    ).otherwise(F.to_json(F.struct(F.col("error"))))
    return out.withColumn("body", body)


def requests_from_features(features: DataFrame, feats: list[str]) -> DataFrame:
    """One flat JSON request per feature row (NULL features are left out of the JSON)."""
    return features.select("date", "ticker", F.to_json(F.struct(*[F.col(f) for f in feats])).alias("request"))


def check_export(model: DataFrame, demo: dict[str, float]) -> DataFrame:
    """Self-check: the JSON model's dot product on the demo row."""
    x = F.array(*[F.lit(float(demo[f])) for f in demo])
    names = list(demo)
    xs = F.transform(F.col("features"), lambda f: F.element_at(x, F.array_position(F.array(*[F.lit(n) for n in names]), f).cast("int")))
    return model.select(dot(F.col("coef"), xs, F.col("intercept")).alias("pred"))
