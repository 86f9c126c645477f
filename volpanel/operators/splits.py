"""Chronological splits: row-weighted cutoffs, two/three-way splits, walk-forward folds.

Everything that needs a global order works on the *distinct dates* (bounded by the
calendar span), never on panel rows: they are gathered into one sorted array by a
partial + final aggregate, and the result goes back to the panel as a one-row table of
edge dates, attached as a scalar subquery (computed once, no join) and compared
against each row's date, so the panel itself is never re-shuffled for a split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volpanel.schemas import N_FOLDS, SPLIT_THREE, TEST_FRAC
from volpanel.operators.sketch import from_key, select_rank
from volpanel.session import reuse, write_once
from volpanel.functions.rows import require_date, with_row


def floor_index(n: Column, q: float) -> Column:
    """int(n·q) as Python computes it: double product, truncated."""
    return F.floor(n.cast("double") * F.lit(float(q))).cast("long")


def cutoff_dates(df: DataFrame, qs: list[float], col: str = "date") -> DataFrame:
    """One row: for each q, the date of the row at 0-based index int(n·q) in date order.

    Row-weighted: (date, rows) pairs from a partial + final count, gathered into one
    date-sorted array (one entry per calendar day, bounded by the calendar span) and
    scanned by a fold that keeps the running row count.  Columns ``c0, c1, …`` in the
    order of ``qs``.
    """
    require_date(df, col)
    per_date = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    arr = per_date.agg(F.array_sort(F.collect_list(F.struct(F.col(col).alias("d"), F.col("_n").alias("n")))).alias("_a"))
    total = F.aggregate(F.col("_a"), F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    arr = arr.select("_a", total.alias("_total"))

    def at(q: float):
        k = floor_index(F.col("_total"), q)
        init = F.struct(F.lit(0).cast("long").alias("cum"), F.lit(None).cast("date").alias("hit"))
        res = F.aggregate(
            F.col("_a"),
            init,
            lambda acc, x: F.struct(
                (acc["cum"] + x["n"]).alias("cum"),
                F.when(acc["hit"].isNull() & (acc["cum"] + x["n"] > k), x["d"]).otherwise(acc["hit"]).alias("hit"),
            ),
        )
        return res["hit"]

    return arr.select(*[at(q).alias(f"c{i}") for i, q in enumerate(qs)])


def split_two(df: DataFrame, test_frac: float = TEST_FRAC, col: str = "date") -> DataFrame:
    """Adds ``set`` = train (date < cutoff) / test (date ≥ cutoff); cutoff at 1 − test_frac."""
    df = reuse(df)
    cut = cutoff_dates(df, [1.0 - test_frac], col)
    return with_row(df, cut).select(
        *df.columns,
        F.when(F.col(col) < F.col("c0"), F.lit("train")).otherwise(F.lit("test")).alias("set"),
        F.col("c0").alias("cutoff"),
    )


def split_three(df: DataFrame, qs: tuple[float, float] = SPLIT_THREE, col: str = "date") -> DataFrame:
    """Adds ``set`` = train / val / test on half-open ranges [.., d1) [d1, d2) [d2, ..)."""
    df = reuse(df)
    cut = cutoff_dates(df, list(qs), col)
    return with_row(df, cut).select(
        *df.columns,
        F.when(F.col(col) < F.col("c0"), F.lit("train"))
        .when(F.col(col) < F.col("c1"), F.lit("val"))
        .otherwise(F.lit("test"))
        .alias("set"),
        F.col("c0").alias("d1"),
        F.col("c1").alias("d2"),
    )


def fold_edges(df: DataFrame, n_folds: int = N_FOLDS, col: str = "date") -> DataFrame:
    """One row of edge dates ``e1 … e{n−1}``: edge i is the distinct date at index int(m·i/n).

    The distinct dates are gathered into one sorted array (a partial + final
    aggregate; one entry per calendar day, bounded by the calendar span).  Bins are
    left-closed: fold = number of edges ≤ date.  With fewer distinct dates than folds
    the edges would repeat, which is an error (raised inside the plan).
    """
    require_date(df, col)
    dates = df.agg(F.array_sort(F.collect_set(col)).alias("_d")).select("_d", F.size("_d").alias("m"))
    edges = dates.select(
        "m",
        *[F.get(F.col("_d"), floor_index(F.col("m"), i / n_folds).cast("int")).alias(f"e{i}") for i in range(1, n_folds)],
    )
    return edges.select(
        "*",
        F.when(F.col("m") >= n_folds, F.lit(True))
        .otherwise(F.raise_error(F.format_string("bin edges must be unique: %d distinct dates for %d folds", F.col("m"), F.lit(n_folds))))
        .alias("_ok"),
    )


def fold_expr(n_folds: int = N_FOLDS, col: str = "date") -> Column:
    total = F.lit(0)
    for i in range(1, n_folds):
        total = total + F.when(F.col(col) >= F.col(f"e{i}"), 1).otherwise(0)
    return total.cast("int")


def assign_folds(df: DataFrame, n_folds: int = N_FOLDS, col: str = "date", purge_col: str | None = None) -> DataFrame:
    """Adds ``fold`` (0 … n−1) to every row; one row of edges as a scalar subquery, no panel shuffle.

    With ``purge_col`` (e.g. ``target_end``) a second column ``train_fold`` holds the
    fold of that date: a row may train a model for test fold k only if its target ends
    before fold k starts (``train_fold < k``).
    """
    df = reuse(df)
    edges = fold_edges(df, n_folds, col)
    j = with_row(df, edges).where(F.col("_ok"))
    extra = []
    if purge_col:
        # a target that runs past the last date belongs to no test fold: treat it as the last fold
        extra = [F.when(F.col(purge_col).isNull(), F.lit(n_folds - 1)).otherwise(fold_expr(n_folds, purge_col)).alias("train_fold")]
    return j.select(*df.columns, fold_expr(n_folds, col).alias("fold"), *extra)


def fold_calendar(df: DataFrame, n_folds: int = N_FOLDS, col: str = "date") -> DataFrame:
    """(date, fold) for every distinct date."""
    return assign_folds(df.select(col).distinct(), n_folds, col)


def fold_profile(folded: DataFrame, col: str = "date") -> DataFrame:
    """Per fold: first date, last date, rows."""
    return folded.groupBy("fold").agg(
        F.min(col).alias("start"), F.max(col).alias("end"), F.count(F.lit(1)).cast("long").alias("rows")
    )


def label_set(fold: Column) -> Column:
    """fold 0 is in-sample (``train``); later folds are out-of-sample (``test``)."""
    return F.when(fold == 0, F.lit("train")).otherwise(F.lit("test"))


# ---- splits of columns that the calendar does not bound (timestamps, numbers) -----------

def cutoff_values(df: DataFrame, qs: list[float], col: str) -> DataFrame:
    """``cutoff_dates`` for any ordered column: one row ``c0, c1, ...``, found by range counting.

    No array of distinct values, no sort: a pass counts at most a few hundred sub-ranges per cutoff."""
    got = select_rank(df, col, [floor_index(F.col("n"), q) for q in qs])
    return got.select(*[from_key(df, col, F.col(f"r{i}")).alias(f"c{i}") for i in range(len(qs))])


def fold_edge_values(df: DataFrame, n_folds: int = N_FOLDS, col: str = "date") -> DataFrame:
    """``fold_edges`` for any ordered column: edge i is the distinct value at index int(m*i/n)."""
    values = write_once(df.select(col).where(F.col(col).isNotNull()).distinct(), "values")
    got = select_rank(values, col, [floor_index(F.col("n"), i / n_folds) for i in range(1, n_folds)])
    edges = got.select(F.col("n").alias("m"), *[from_key(df, col, F.col(f"r{i - 1}")).alias(f"e{i}") for i in range(1, n_folds)])
    enough = F.when(F.col("m") >= n_folds, F.lit(True)).otherwise(
        F.raise_error(F.format_string("bin edges must be unique: %d distinct values for %d folds", F.col("m"), F.lit(n_folds))))
    return edges.select("*", enough.alias("_ok"))


def assign_folds_by_value(df: DataFrame, n_folds: int = N_FOLDS, col: str = "date") -> DataFrame:
    """``assign_folds`` for any ordered column; the rows themselves are not moved."""
    j = with_row(df, fold_edge_values(df, n_folds, col)).where(F.col("_ok"))
    return j.select(*df.columns, fold_expr(n_folds, col).alias("fold"))
