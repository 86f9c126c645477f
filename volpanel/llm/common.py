"""Helpers shared by the corpus operators: table access, shared-folder tables, word rules.

Intermediate tables go to the folder the cluster names in ``spark.checkpoint.dir`` (never to a
machine-local folder), so lost executors cost a re-read and lineage stays short.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volpanel.session import ensure_checkpoint_dir

#: characters that part words and are stripped from lines: space and U+0009..U+000D
BLANKS = " \t\n\x0b\x0c\r"
#: the same as an expression for Java regular expressions
BLANK_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: each part is computed once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_fs(path: str):
    """(filesystem, path) with which a Python worker opens a file of the shared folder."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def worker_rows(path: str):
    """Arrow table of a Parquet folder in the shared folder, read inside a worker."""
    import pyarrow.dataset as ds

    files, where = worker_fs(path)
    return ds.dataset(where, filesystem=files, format="parquet").to_table()


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on after a task, beside the next stage's."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, everything else unchanged (``lower`` alone would also fold other letters)."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_order_key(docs: DataFrame, name: str, own_text: bool = False) -> DataFrame:
    """``docs`` with ``name``: a long that orders rows as doc_id does (null where doc_id is null).

    Whole-number ids are their own keys.  Ids of other types get numbers in their order; with ``own_text``, so do tables in which rows
    of one doc_id have different texts, and those rows get numbers of their own."""
    kind = docs.schema["doc_id"].dataType
    plain = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if plain and own_text:
        text = F.xxhash64("text")
        plain = not docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a <> b").head(1)
    if plain:
        return docs.withColumn(name, F.col("doc_id").cast("long"))
    rows = docs.withColumn(f"{name}_t", F.xxhash64("text") if own_text else F.lit(0).cast("long"))
    keys = rows.where("doc_id is not null").select(F.col("doc_id").alias(f"{name}_d"), F.col(f"{name}_t").alias(f"{name}_u")).distinct()
    # numbers grow along sorted ranges
    keys = keys.repartitionByRange(shuffle_parts(docs.sparkSession), f"{name}_d", f"{name}_u").sortWithinPartitions(f"{name}_d", f"{name}_u")
    keys = stored(keys.withColumn(name, F.monotonically_increasing_id()), "order-keys")
    on = (F.col("doc_id") == F.col(f"{name}_d")) & (F.col(f"{name}_t") == F.col(f"{name}_u"))
    return rows.join(keys, on, "left").select(*docs.columns, name)


def group_min(rows: DataFrame, keys: list[str], value: str, out: str, salts: int = 64) -> DataFrame:
    """``rows`` with ``out`` = the smallest ``value`` among the rows of equal ``keys``.

    No key's rows meet in one task: rows are first reduced per (keys, salt), at most ``salts``
    partial rows of a key meet in a window, and the rows join their own salt's partial row.
    """
    salt = F.pmod(F.xxhash64(F.col(value)), F.lit(salts)).cast("int")
    salted = rows.withColumn("_salt", salt)
    part = salted.groupBy(*keys, "_salt").agg(F.min(value).alias("_least"))
    from pyspark.sql import Window

    best = part.withColumn(out, F.min("_least").over(Window.partitionBy(*keys))).drop("_least")
    named = best.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_salt").alias("_s"), out)
    on = F.col("_salt") == F.col("_s")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return salted.join(named, on, "left").drop("_salt", "_s", *[f"_k{i}" for i in range(len(keys))])
