"""Versioned tables: a replacement that survives a failure at any point.

``<path>/data/<version>`` holds one written version, ``<path>/pointers`` one row per published version.  A version is
written whole, then its pointer row; readers resolve the newest pointer and read only that version's folder.  A
writer that fails leaves no pointer, so the version before stays the table; nothing is deleted before its successor stands.
One writer at a time; readers need no lock: a reader that has resolved a version keeps reading it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "number long, version string, rows long, written timestamp, note string"


def pointers(spark: SparkSession, path: str) -> DataFrame:
    """The published versions (POINTER rows); empty for a table that was never published."""
    try:
        return spark.read.schema(POINTER).parquet(f"{path}/pointers")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POINTER)


def current(spark: SparkSession, path: str, number: int | None = None):
    """The newest pointer row, or that of one number; None if there is none."""
    rows = pointers(spark, path)
    if number is not None:
        rows = rows.where(F.col("number") == number)
    return rows.orderBy(F.col("number").desc(), F.col("version").desc()).limit(1).first()


def publish(df: DataFrame, path: str, note: str = "", partition_by: list[str] | None = None) -> int:
    """Write ``df`` as the next version of the table and return its number."""
    spark = df.sparkSession
    last = current(spark, path)
    number, version = (last["number"] if last else 0) + 1, uuid.uuid4().hex
    where = f"{path}/data/{version}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(where)
    rows = spark.read.schema(df.schema).parquet(where).count()
    row = spark.createDataFrame([(number, version, rows, note)], "number long, version string, rows long, note string")
    row = row.select("number", "version", "rows", F.current_timestamp().alias("written"), "note")
    row.coalesce(1).write.mode("append").parquet(f"{path}/pointers")
    return number


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version of the table, or one by its number."""
    row = current(spark, path, number)
    if row is None:
        raise FileNotFoundError(f"no published version under {path}" + ("" if number is None else f" with number {number}"))
    return spark.read.parquet(f"{path}/data/{row['version']}")
