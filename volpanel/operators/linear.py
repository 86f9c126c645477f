"""Ordinary least squares from sufficient statistics, solved inside the plan.

One aggregation pass collects, per group (e.g. per fold), the count, Σxᵢ, Σy,
Σxᵢxⱼ and Σxᵢy of centred features — a partial + final aggregate whose size is (p+1)² numbers per
group, independent of the row count.  Expanding training sets (``fold < k``) are
prefix sums over the few group rows.  The normal equations of the centred problem
are solved by Gauss–Jordan elimination written as one array expression, so
coefficients never leave the JVM.  Coefficient rows (one per fold) are broadcast
back to the rows to score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volpanel.functions.rows import with_row
from volpanel.functions.scalar import dot
from volpanel.session import write_once


def _pairs(p: int):
    return [(i, j) for i in range(p) for j in range(i, p)]


def gram(df: DataFrame, feats: list[str], y: str, by: list[str]) -> DataFrame:
    """Sufficient statistics per group: n, s{i}, sy, s{i}_{j} (i ≤ j), s{i}y, and the shifts h{i}.

    Sums are taken of features less their overall mean h{i} (a one-row aggregate, inlined), so that
    products of features far from zero keep their digits; every group carries the shifts."""
    shifts = df.agg(*[F.avg(f).alias(f"_h{i}") for i, f in enumerate(feats)])
    df = with_row(df.select(*by, *feats, y), shifts)
    out = df.groupBy(*by).agg(*sums_of(feats, [F.col(f"_h{i}") for i in range(len(feats))], y))
    # the shifts are the same in all groups: attached behind the aggregate, which stays narrow enough for generated code
    return with_row(out, shifts.toDF(*[f"h{i}" for i in range(len(feats))]))


def shifted_gram(df: DataFrame, feats: list[str], y: str, by: list[str], shifts: list[float]) -> DataFrame:
    """``gram`` with shifts that are given: statistics of separate tables then add up."""
    out = df.groupBy(*by).agg(*sums_of(feats, [F.lit(float(h)) for h in shifts], y))
    return out.select("*", *[F.lit(float(h)).alias(f"h{i}") for i, h in enumerate(shifts)])


def sums_of(feats: list[str], shifts: list[Column], y: str) -> list[Column]:
    p = len(feats)
    x = [F.col(f) - h for f, h in zip(feats, shifts)]
    aggs = [F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(y)).alias("sy")]
    aggs += [F.sum(x[i]).alias(f"s{i}") for i in range(p)]
    aggs += [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i, j in _pairs(p)]
    return aggs + [F.sum(x[i] * F.col(y)).alias(f"s{i}y") for i in range(p)]


def stat_names(p: int) -> list[str]:
    return ["n", "sy"] + [f"s{i}" for i in range(p)] + [f"s{i}_{j}" for i, j in _pairs(p)] + [f"s{i}y" for i in range(p)]


def expanding(g: DataFrame, p: int, order: str = "fold", include_first: bool = False) -> DataFrame:
    """Training statistics of every group k = sums over groups < k (the few group rows).

    With ``include_first`` the first group (no earlier data) uses its own statistics,
    i.e. an in-sample fit.
    """
    w_prev = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = [F.col(order)]
    for s in stat_names(p):
        prev = F.sum(s).over(w_prev)
        out.append((F.coalesce(prev, F.col(s)) if include_first else prev).alias(s))
    w_all = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out += [F.max(f"h{i}").over(w_all).alias(f"h{i}") for i in range(p)]
    res = g.select(*out)
    return res.where(F.col("n").isNotNull())


#: a feature whose variance, or whose part not explained by the features before it, is below this
#: share of its scale is constant or collinear: its coefficient is 0
RANK_TOLERANCE = 1e-10


def solve(stats: DataFrame, p: int, keep: list[str]) -> DataFrame:
    """Coefficients b0…b{p−1} and intercept from the sufficient statistics.

    Centred normal equations C·b = c with C = Σxxᵀ/n − x̄x̄ᵀ, c = Σxy/n − x̄ȳ, scaled to
    correlations.  The augmented matrix [C | c] is an array column and Gauss–Jordan elimination is one
    ``aggregate`` over the pivot index; a pivot below ``RANK_TOLERANCE`` is passed over and its
    feature gets coefficient 0, so constant and collinear features still yield a least-squares model.
    intercept = ȳ − (x̄ + h)·b with the shifts h of ``gram``.
    """
    n = F.col("n")
    mean = [F.col(f"s{i}") / n for i in range(p)]
    my = F.col("sy") / n

    def s(i: int, j: int) -> Column:
        return F.col(f"s{min(i, j)}_{max(i, j)}")

    raw = [s(i, i) / n for i in range(p)]
    var = [F.greatest(F.lit(0.0), raw[i] - mean[i] * mean[i]) for i in range(p)]
    # 1/sd, or 0 for a feature without variance
    inv = [F.when(var[i] > F.lit(RANK_TOLERANCE * 1e-4) * raw[i], F.lit(1.0) / F.sqrt(var[i])).otherwise(F.lit(0.0)) for i in range(p)]
    prepared = stats.select(
        *keep, my.alias("_my"), *[(mean[i] + F.col(f"h{i}")).alias(f"_m{i}") for i in range(p)], F.array(*inv).alias("_inv"),
        F.array(*[F.array(*[s(i, j) / n - mean[i] * mean[j] for j in range(p)], F.col(f"s{i}y") / n - mean[i] * my) for i in range(p)]).alias("_raw"),
    )
    scaled = F.transform(F.col("_raw"), lambda row, i: F.transform(row, lambda v, j: v * F.get("_inv", i) * F.coalesce(F.get("_inv", j), F.lit(1.0))))

    def step(m: Column, k: Column) -> Column:
        piv = F.get(m, k)
        d = F.get(piv, k)
        eliminated = F.transform(
            m,
            lambda row, i: F.when(i == k, F.transform(row, lambda x: x / d)).otherwise(
                F.zip_with(row, piv, lambda a, b: a - F.get(row, k) * b / d)
            ),
        )
        # no pivot: the feature's row and column become zero
        skipped = F.transform(m, lambda row, i: F.when(i == k, F.transform(row, lambda x: F.lit(0.0))).otherwise(F.transform(row, lambda x, j: F.when(j == k, F.lit(0.0)).otherwise(x))))
        return F.when(d > RANK_TOLERANCE, eliminated).otherwise(skipped)

    solved = F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), F.col("_aug"), step)
    cur = prepared.select(*keep, "_my", *[f"_m{i}" for i in range(p)], "_inv", scaled.alias("_aug"))
    cur = cur.select(*keep, "_my", *[f"_m{i}" for i in range(p)], "_inv", solved.alias("_aug"))
    b = [F.get(F.get(F.col("_aug"), F.lit(i)), F.lit(p)) * F.get("_inv", F.lit(i)) for i in range(p)]
    intercept = F.col("_my")
    for i in range(p):
        intercept = intercept - F.col(f"_m{i}") * b[i]
    return cur.select(*keep, *[b[i].alias(f"b{i}") for i in range(p)], intercept.alias("intercept"))


def fit(df: DataFrame, feats: list[str], y: str, by: list[str] | None = None) -> DataFrame:
    """One coefficient row per group (or one row overall)."""
    by = by or []
    g = gram(df, feats, y, by) if by else gram(df.withColumn("_all", F.lit(0)), feats, y, ["_all"])
    return solve(g, len(feats), by or ["_all"])


def fit_walk_forward(folded: DataFrame, feats: list[str], y: str, include_first: bool = False, purge: bool = False) -> DataFrame:
    """Coefficients for each test fold k, trained on folds < k (fold 0 in-sample if asked).

    With ``purge`` the statistics are grouped by ``train_fold`` (the fold in which a
    row's target ends), so rows whose target overlaps fold k do not train its model.
    """
    p = len(feats)
    if purge:
        g = gram(folded.withColumn("fold", F.col("train_fold")), feats, y, ["fold"])
        # every test fold needs a row even if no target ends inside it
        folds = folded.select("fold").distinct()
        g = folds.join(g, "fold", "left").na.fill(0.0, subset=stat_names(p))
    else:
        g = gram(folded, feats, y, ["fold"])
    g = write_once(g, "gram")
    return solve(expanding(g, p, "fold", include_first), p, ["fold"])


def predict(df: DataFrame, coefs: DataFrame, feats: list[str], on: list[str], out: str = "pred") -> DataFrame:
    """Score rows with the coefficient row of their group.

    Coefficients are broadcast only for folds and for the single overall model, whose number is
    bounded; for other groups (one row per ticker, say) the planner decides by measured size."""
    p = len(feats)
    bounded = set(on) <= {"fold", "_all"}
    j = df.join(F.broadcast(coefs) if bounded else coefs, on, "inner")
    pred = dot([F.col(f"b{i}") for i in range(p)], [F.col(f) for f in feats], F.col("intercept"))
    return j.select(*df.columns, pred.alias(out))


def score_with(df: DataFrame, model: DataFrame, feats: list[str], out: str = "pred") -> Column:
    """Positional dot product against a model row carrying ``coef`` / ``intercept`` arrays."""
    return dot(F.col("coef"), F.array(*[F.col(f) for f in feats]), F.col("intercept")).alias(out)


def sub_stats(g: DataFrame, feats: list[str], subset: list[str], keep: list[str]) -> DataFrame:
    """The sufficient statistics of a feature subset, read off a superset's statistics."""
    idx = [feats.index(f) for f in subset]
    cols = [F.col("n"), F.col("sy")]
    cols += [F.col(f"s{a}").alias(f"s{i}") for i, a in enumerate(idx)]
    for i, j in _pairs(len(idx)):
        a, b = sorted((idx[i], idx[j]))
        cols.append(F.col(f"s{a}_{b}").alias(f"s{i}_{j}"))
    cols += [F.col(f"s{a}y").alias(f"s{i}y") for i, a in enumerate(idx)]
    cols += [F.col(f"h{a}").alias(f"h{i}") for i, a in enumerate(idx)]
    return g.select(*keep, *cols)


def fit_walk_forward_sets(folded: DataFrame, sets: dict[str, list[str]], y: str) -> DataFrame:
    """Walk-forward coefficients of several feature sets from ONE statistics pass.

    The statistics are gathered once over the union of the sets (a set's statistics
    are a sub-block of the union's); each set is solved on the few fold rows.  Returns
    one row per test fold with ``c{t}_b{i}`` / ``c{t}_intercept`` for set number t.
    """
    union: list[str] = []
    for feats in sets.values():
        union += [f for f in feats if f not in union]
    # the few fold rows are written once: the solves then plan over a tiny table, not over the panel
    g = write_once(gram(folded, union, y, ["fold"]), "gram")
    out = None
    for t, feats in enumerate(sets.values()):
        p = len(feats)
        c = solve(expanding(sub_stats(g, union, feats, ["fold"]), p, "fold"), p, ["fold"])
        c = c.select("fold", *[F.col(f"b{i}").alias(f"c{t}_b{i}") for i in range(p)], F.col("intercept").alias(f"c{t}_intercept"))
        out = c if out is None else out.join(c, "fold")
    return out
