"""Refits by increments: one row of sufficient statistics per day, kept as a versioned table.

A day's row holds the sums of ``linear.gram`` with shifts fixed when the table was made, so rows of different days
add up.  A new day adds one row (a day that is delivered again replaces its row); a model of any prefix of days
is the sum of their rows, solved, without reading the panel again.  The table has one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from volpanel.functions.rows import require_date
from volpanel.operators import linear
from volpanel.sources import versions


def day_statistics(df: DataFrame, feats: list[str], y: str, shifts: list[float] | None = None) -> DataFrame:
    """(date, n, sums, h0, h1, ...): statistics per day; ``shifts`` default to the means of ``df``."""
    require_date(df)
    if shifts is None:
        shifts = [v or 0.0 for v in df.agg(*[F.avg(f).alias(f) for f in feats]).first()]
    return linear.shifted_gram(df, feats, y, ["date"], shifts)


def start(df: DataFrame, feats: list[str], y: str, path: str) -> int:
    """The first version of a statistics table; its shifts stay those of ``df``."""
    return versions.publish(day_statistics(df, feats, y), path, note=",".join(feats))


def add_days(spark: SparkSession, path: str, df: DataFrame, feats: list[str], y: str) -> int:
    """The next version: days of ``df`` are added, or replace the rows that they had."""
    known = versions.read(spark, path)
    if versions.current(spark, path)["note"] != ",".join(feats):
        raise ValueError("the table holds statistics of other features")
    first = known.select(*[f"h{i}" for i in range(len(feats))]).limit(1).first()
    new = day_statistics(df, feats, y, list(first) if first else None)
    kept = known.join(new.select(F.col("date").alias("_date")), F.col("date") == F.col("_date"), "left_anti")
    return versions.publish(kept.unionByName(new), path, note=",".join(feats))


def refit(stats: DataFrame, p: int, upto=None) -> DataFrame:
    """The model of all days, or of those up to a date."""
    rows = stats if upto is None else stats.where(F.col("date") <= F.lit(upto))
    sums = rows.agg(*[F.sum(s).alias(s) for s in linear.stat_names(p)], *[F.max(f"h{i}").alias(f"h{i}") for i in range(p)])
    return linear.solve(sums.where("n is not null"), p, [])


def refit_each(stats: DataFrame, p: int, dates: DataFrame) -> DataFrame:
    """(date, n, b0, ..., intercept): the model of every prefix that ends at one of ``dates``."""
    before = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per day
    prefix = stats.select("date", *[F.sum(s).over(before).alias(s) for s in linear.stat_names(p)], *[f"h{i}" for i in range(p)])
    asked = prefix.join(F.broadcast(dates.select(F.col("date").alias("_date")).distinct()), F.col("date") == F.col("_date"), "left_semi")
    return linear.solve(asked.withColumn("rows", F.col("n").cast("long")), p, ["date", "rows"])
