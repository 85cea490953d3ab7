"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes = threading.local()
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pin_utc(spark: SparkSession) -> SparkSession:
    """All bar and tick times are UTC, so the session time zone must be too."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only where that setting is absent and the master is a single local process, a local temporary folder is used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/barlake/{label}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=f"barlake-{label}-")


def stored(frame: DataFrame, label: str, keep: bool = False, outer: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back: later passes scan columns instead of recomputing.

    Inside ``scratch_scope`` the table goes with the scope, unless ``keep`` says that a result still reads it, or with the scope
    around it if ``outer`` says so. Shuffle files behind the table go as soon as it is complete, rather than when the
    driver's garbage collector finds them.
    """
    folder = scratch_dir(frame.sparkSession, label)
    path = f"{folder}/table"
    open_scopes = getattr(_scopes, "stack", [])
    if len(open_scopes) > outer and not keep:
        open_scopes[-2 if outer else -1].append(folder)
    conf = frame.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables stored inside once the block ends; frames that leave the block must not read them."""
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for folder in stack.pop():
            remove_folder(spark, folder)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as Spark's own readers resolve them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def subfolders(spark: SparkSession, path: str, files: bool = False) -> list[str]:
    """Names of the folders (or files) in a folder; none if it does not exist."""
    system, target = _hadoop(spark, path)
    if not system.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(target) if entry.isDirectory() != files)


def remove_folder(spark: SparkSession, path: str) -> None:
    system, target = _hadoop(spark, path)
    system.delete(target, True)
