"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "sftforge") -> SparkSession:
    """A local session tuned for tests and the bench (UI off, AQE on)."""
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    parts = shuffle_partitions or max(8, 2 * n)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "10g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``sftforge`` importable in Python workers (pandas UDFs, mapInArrow).

    Zips the package once per application and ships it with ``addPyFile``, so
    executors need no pre-installed copy.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: ship with spark.addArtifacts instead
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="sftforge-pyfiles-"), "sftforge")
    archive = shutil.make_archive(out, "zip", os.path.dirname(pkg_dir), "sftforge")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage.  Only a local-mode
    session (tests, the bench) gets a fresh folder under the temp dir when unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sftforge-ckpt-"))
    return sc.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system; other failures rise."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and all below it, as a write in overwrite mode does; nothing if there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside cut the same files into the same ranges, also if executors come or go between them.

    Spark takes the ranges' size from the number of cores there are; the number at
    the beginning holds for all of them.
    """
    key = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(key, None)
    if old is None:
        spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs re-read the files instead of re-running the
    plan, and a lost executor does not force recomputation past this point.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{name}-{uuid.uuid4().hex[:12]}"
