"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever the operator configured as
``spark.checkpoint.dir`` (a shared file system such as HDFS or an object
store). We only ever *read* that setting; a private folder is created
only when the session is local and nothing is configured (tests, bench).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = 8, app: str = "recsmith", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode
    session without that setting gets a private temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        # Spark appends a uuid folder to the configured checkpoint dir.
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: configure a shared folder for checkpoints on the cluster"
        )
    path = tempfile.mkdtemp(prefix="recsmith-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder; it is removed when the application ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared scratch folder.

    Survives executor loss (the data lives on the shared file system, not
    on executor disks), unlike ``localCheckpoint``.
    """
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Inside, shuffle files go as soon as their query ends, not when the driver's next garbage collection happens to come."""
    before = spark.conf.get(CLEANUP_CONF)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table of the shared scratch folder and read back.

    Its shuffle files are dropped as soon as it is written, so what is on disk at
    once is one step's shuffles and not those of all steps so far.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written_meanwhile(df: DataFrame, name: str):
    """``written``, and deleted at the end of the block."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield _written(df, path)
    finally:
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a path that ``scratch_path`` gave."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def drop_unreferenced(spark: SparkSession) -> None:
    """Has Spark drop the shuffle files and cached blocks that nothing on the driver refers to any more, now."""
    gc.collect()
    spark._jvm.System.gc()
