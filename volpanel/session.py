"""Session helpers.

Library code never creates a session; these helpers exist for tests, the bench
and the command-line entry points.  On a cluster the submitter owns the session
configuration, and ``checkpoint_dir`` only reads what the cluster names.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "volpanel") -> SparkSession:
    """A local session with AQE on and the web UI off (tests and bench only)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VOLPANEL_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Spark applies that setting when the context starts; it cannot be changed at run
    time.  Only when nothing is configured and the master is local (tests) do we point
    the context at a scratch folder of our own.
    """
    sc = spark.sparkContext
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (a machine-local folder is not safe on a cluster)")
    path = tempfile.mkdtemp(prefix="volpanel-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def reuse(df):
    """Persist a DataFrame an operator reads more than once (memory, spilling to disk).

    A lost executor's blocks are recomputed from lineage, so this is safe on a
    cluster; callers release it with ``unpersist`` or ``spark.catalog.clearCache()``.
    """
    from pyspark import StorageLevel

    if df.storageLevel == StorageLevel.NONE:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


def write_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_files(path: str):
    """(filesystem, path) with which a Python worker opens a file of the shared folder."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def write_once(df, name: str = "table"):
    """Write ``df`` to a new folder under the shared checkpoint folder and read it back.

    For frames that hold layout-dependent values (partition ids, row numbers) and are read by
    several branches: every reader sees the same written values, whatever is cached or reused.
    """
    path = write_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cpu_partitions(df) -> int:
    """Task count for CPU-heavy stages whose input is small in bytes.

    Adaptive execution would coalesce such input into a few tasks; an explicit
    ``repartition(n)`` keeps it spread over the cluster (AQE leaves a user-specified
    partition count alone).
    """
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stable(df):
    """Write ``df`` to the shared checkpoint folder and cut its lineage (reliable checkpoint).

    For inputs of long multi-job work (tree candidates): a lost executor then costs a
    re-read of the checkpoint, not a recomputation from the source tables.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
