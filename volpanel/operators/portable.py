"""Tree models as one row of node arrays, scored by an expression.

``trees`` holds per tree the arrays ``feature`` (-1 at a leaf), ``threshold`` (values up to it go left), ``left``, ``right`` and
``value``, and the tree's ``weight``.  A prediction is the intercept plus the weighted sum of the leaves that a row
reaches: built-in array functions, no model library and no Python where it is scored.  The row travels as JSON like the linear
model's and goes through the same request scoring.  Its size is that of the model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volpanel.session import write_path

TREE = "struct<feature:array<int>,threshold:array<double>,left:array<int>,right:array<int>,value:array<double>,weight:double>"


def nodes_of(trees: Column) -> Column:
    """The trees as (weight, nodes), made once per model: a step of a walk fetches one node; a leaf leads to itself."""
    def nodes(t: Column) -> Column:
        def node(f: Column, i: Column) -> Column:
            leaf = f < 0
            return F.struct(F.when(leaf, 0).otherwise(f).alias("f"), F.get(t["threshold"], i).alias("c"), F.when(leaf, i).otherwise(F.get(t["left"], i)).alias("l"),
                            F.when(leaf, i).otherwise(F.get(t["right"], i)).alias("r"), F.get(t["value"], i).alias("v"))

        return F.struct(t["weight"].alias("weight"), F.transform(t["feature"], node).alias("nodes"))

    return F.transform(trees, nodes)


def tree_score(trees: Column, x: Column, intercept: Column, depth: int | Column) -> Column:
    """Prediction of ``nodes_of`` trees for the feature array ``x``; no tree is deeper than ``depth`` (one at least)."""
    levels = F.sequence(F.lit(1), depth if isinstance(depth, Column) else F.lit(depth))

    def leaf(t: Column) -> Column:
        return F.aggregate(levels, F.get(t["nodes"], F.lit(0)), lambda n, _: F.get(t["nodes"], F.when(F.get(x, n["f"]) <= n["c"], n["l"]).otherwise(n["r"])))

    return F.aggregate(trees, intercept.cast("double"), lambda total, t: total + t["weight"] * leaf(t)["v"])


def portable_row(trees: DataFrame, feats: list[str], intercept: float, depth: int, kind: str, log_space: bool = False) -> DataFrame:
    """One row (features, intercept, depth, kind, log_space, trees) from rows (tree, and the fields of TREE)."""
    one = F.struct("tree", "feature", "threshold", "left", "right", "value", "weight")
    row = trees.agg(F.array_sort(F.collect_list(one)).alias("_t"))
    return row.select(
        F.array(*[F.lit(f) for f in feats]).alias("features"), F.lit(float(intercept)).alias("intercept"), F.lit(max(1, int(depth))).alias("depth"), F.lit(kind).alias("kind"),
        F.lit(log_space).alias("log_space"), F.transform("_t", lambda t: t.dropFields("tree")).cast(f"array<{TREE}>").alias("trees"))


def from_grid(grid, trees: DataFrame, fit: int, upto: int, depth: int | None = None, log_space: bool = False) -> DataFrame:
    """The portable row of one fit of ``hist_trees.fit_grid`` (forests: walked to ``depth``, if less than fitted)."""
    from volpanel.operators.hist_trees import Forest

    at, spec = grid.fits[fit]
    depth, forest = depth or spec.depth, isinstance(spec, Forest)
    edges = F.array(*[F.array(*[F.lit(float(v)) for v in grid.edges[upto][i]]).cast("array<double>") for i in at])
    own = trees.where((F.col("fit") == fit) & (F.col("upto") == upto))
    inner = F.sequence(F.lit(0), F.size("feature") - 1)
    rows = own.select(
        "tree",
        # below the depth that is walked every node is a leaf
        F.transform(inner, lambda i: F.when(i < (1 << depth) - 1, F.get("feature", i)).otherwise(-1)).alias("feature"),
        F.transform(inner, lambda i: F.get(F.get(edges, F.get("feature", i)), F.get("bin", i))).alias("threshold"),
        F.transform(inner, lambda i: 2 * i + 1).alias("left"), F.transform(inner, lambda i: 2 * i + 2).alias("right"), "value",
        F.lit(1.0 / spec.trees if forest else 1.0).alias("weight"))
    return portable_row(rows, [grid.feats[i] for i in at], 0.0 if forest else grid.mean[upto], depth, "forest" if forest else "boosted", log_space)


def from_model(model, feats: list[str], log_space: bool = False) -> DataFrame:
    """The portable row of what ``trees.fit_model`` returns."""
    from volpanel.operators.hist_trees import FittedForest

    return from_grid(model.grid, model.trees, 0, 1, log_space=log_space) if isinstance(model, FittedForest) else from_spark_ml(model, feats, log_space)


def from_spark_ml(model, feats: list[str], log_space: bool = False) -> DataFrame:
    """The portable row of a fitted Spark ML forest or boosted model, read from its node table."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = write_path(spark, "ml-model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    split = F.col("split")
    per_tree = nodes.groupBy("treeID").agg(F.array_sort(F.collect_list(F.struct(
        "id", F.when(F.col("leftChild") >= 0, split["featureIndex"]).otherwise(-1).alias("feature"), F.when(F.col("leftChild") >= 0, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("prediction").alias("value")))).alias("n"))
    weights = list(model.treeWeights)
    mean = type(model).__name__.startswith("RandomForest")
    weight = F.get(F.array(*[F.lit(float(w) / (sum(weights) if mean else 1.0)) for w in weights]), F.col("treeID"))
    rows = per_tree.select(F.col("treeID").alias("tree"), *[F.col(f"n.{c}").alias(c) for c in ("feature", "threshold", "left", "right", "value")], weight.alias("weight"))
    return portable_row(rows, feats, 0.0, int(model.getMaxDepth()), "forest" if mean else "boosted", log_space)


def predict(df: DataFrame, model: DataFrame, feats: list[str], depth: int, out: str = "pred") -> DataFrame:
    """``df`` with the prediction of a portable row."""
    from volpanel.functions.rows import with_row

    m = model.select(F.struct("intercept", F.coalesce("log_space", F.lit(False)).alias("log_space")).alias("_model"))
    raw = tree_score(F.col("_nodes"), F.array(*[F.col(f).cast("double") for f in feats]), F.col("_model.intercept"), depth)
    j = with_row(with_row(df, m), model.select(nodes_of(F.col("trees")).alias("_nodes"))).withColumn("_raw", raw).drop("_nodes")
    return j.withColumn(out, F.when(F.col("_model.log_space"), F.exp("_raw")).otherwise(F.col("_raw"))).drop("_model", "_raw")
