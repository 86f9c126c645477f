"""Error metrics as aggregate expressions (partial + final aggregation, no collect)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volpanel.functions.scalar import ratio


def sq_err(y: str, p: str) -> Column:
    d = F.col(p) - F.col(y)
    return d * d


def rmse(y: str, p: str) -> Column:
    return F.sqrt(F.avg(sq_err(y, p)))


def mae(y: str, p: str) -> Column:
    return F.avg(F.abs(F.col(p) - F.col(y)))


def r2(y: str, p: str) -> Column:
    """1 − SS_res/SS_tot against the scored set's own mean; zero variance → 1 or 0."""
    ss_res = F.sum(sq_err(y, p))
    scored = F.when(F.col(p).isNotNull(), F.col(y))
    ss_tot = F.var_pop(scored) * F.count(scored)
    return F.when(ss_tot > 0, F.lit(1.0) - ss_res / ss_tot).when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def metrics(df: DataFrame, y: str, p: str, by: list[str] | None = None, unscored: bool = False) -> DataFrame:
    """rows, RMSE, MAE, R² per group (or overall).

    ``rows`` counts the rows that were scored; with ``unscored`` a column of that name counts
    those without a prediction, which no average may hide."""
    aggs = [
        F.count(F.col(p)).cast("long").alias("rows"),
        rmse(y, p).alias("RMSE"),
        mae(y, p).alias("MAE"),
        r2(y, p).alias("R2"),
    ]
    if unscored:
        aggs.append(F.count_if(F.col(p).isNull()).cast("long").alias("unscored"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def summarise_folds(per_fold: DataFrame, by: list[str], score: str = "RMSE") -> DataFrame:
    """Mean and population std of the fold scores, plus the scores in fold order (6 places)."""
    return per_fold.groupBy(*by).agg(
        F.avg(score).alias(f"mean_{score}"),
        F.stddev_pop(score).alias(f"std_{score}"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("fold", score))), lambda s: F.round(s[score], 6)
        ).alias(f"fold_{score}s"),
    )


def improvement(base: Column, best: Column) -> Column:
    """Improvement over the baseline in percent: (b − m)/b · 100; NULL for a zero baseline."""
    return ratio(base - best, base) * F.lit(100.0)


def best(board: DataFrame, score: str, tie_break: list[str]) -> DataFrame:
    """The lowest-score candidate, with an explicit tie-break (a top-1, not a sort)."""
    return board.orderBy(F.col(score).asc(), *[F.col(c).asc() for c in tie_break]).limit(1)
