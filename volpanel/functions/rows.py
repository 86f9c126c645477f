"""Attaching one-row results (bounds, cutoffs, edges, flags, a model) to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_date(df: DataFrame, col: str = "date") -> None:
    """Raise unless ``col`` is a date: its distinct values are then bounded by the calendar, so that
    one array, one un-partitioned window or one broadcast may hold them (a timestamp would not be)."""
    kind = df.schema[col].dataType
    if not isinstance(kind, T.DateType):
        raise TypeError(f"{col} must be a date column, not {kind.simpleString()}")


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` plus the columns of the single row of ``one_row``, on every row.

    Expressed as a scalar subquery (not a join): Spark computes the one-row result once,
    before the main plan, and inlines it; no rows of ``df`` move.  ``one_row`` must hold
    exactly one row (a global aggregate or a one-row model table).
    """
    sub = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.withColumn("_one_row", sub).select("*", "_one_row.*").drop("_one_row")
