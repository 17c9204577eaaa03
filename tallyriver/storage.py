"""Shared folders, path helpers and the size check before a broadcast."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
#: Spark removes the shuffle files of a run when it has ended, not when the driver collects its garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path for ``purpose`` that all executors can reach.

    It lies below ``spark.checkpoint.dir``. Where that is unset the function
    falls back to a temporary folder, but only in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="tallyriver-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


@contextlib.contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """What is run meanwhile has these settings of the session, whose own come back then."""
    own = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in own.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(jpath)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, jsource = _hadoop_path(spark, source)
    _, jtarget = _hadoop_path(spark, target)
    if not fs.rename(jsource, jtarget):
        raise OSError(f"could not rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop_path(spark, path)
    fs.mkdirs(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty if it does not exist."""
    fs, jpath = _hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def current_folder(spark: SparkSession, path: str, below: int | None = None) -> str | None:
    """The newest version (before ``below``) under ``path`` that was written completely; None without any."""
    names = [n for n in child_names(spark, path) if n.startswith("version=")]
    if below is not None:
        names = [n for n in names if int(n.split("=")[1]) < below]
    for name in sorted(names, key=lambda n: -int(n.split("=")[1])):
        if path_exists(spark, f"{path}/{name}/_SUCCESS"):
            return f"{path}/{name}"
    return None


def next_version(spark: SparkSession, path: str) -> str:
    versions = [int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith("version=")]
    return f"{path}/version={max(versions, default=0) + 1}"


def publish(df: DataFrame, path: str, version: int | None = None) -> str:
    """Write ``df`` as a new version below ``path``; it counts once its success marker is there.

    Older versions stay, so readers that have begun go on, and a failed write changes nothing. ``version`` names the
    version, so that a repeated write replaces its own.
    """
    folder = next_version(df.sparkSession, path) if version is None else f"{path}/version={version}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def staged_folder(path: str) -> str:
    """A new folder beside ``path``, on the same file system."""
    return f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"


def publish_staged(spark: SparkSession, staged: str, path: str) -> str:
    """Make a checked folder the newest version by one rename."""
    folder = next_version(spark, path)
    make_folder(spark, path)
    rename_path(spark, staged, folder)
    return folder


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version below ``path``."""
    folder = current_folder(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(folder)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    fs, jpath = _hadoop_path(spark, path)
    fs.delete(jpath, True)


def drop_old_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the newest ``keep`` complete versions, and older incomplete ones."""
    names = [n for n in child_names(spark, path) if n.startswith("version=")]
    names.sort(key=lambda n: -int(n.split("=")[1]))
    complete = 0
    for name in names:
        if complete >= keep:
            drop_path(spark, f"{path}/{name}")
        complete += path_exists(spark, f"{path}/{name}/_SUCCESS")


def drop_batches(spark: SparkSession, path: str, last: int) -> None:
    """Remove the folders ``batch_id=N`` below ``path`` up to batch ``last``."""
    for name in child_names(spark, path):
        if name.startswith("batch_id=") and int(name.split("=")[1]) <= last:
            drop_path(spark, f"{path}/{name}")


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``; huge when it does not know."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """Add a broadcast hint if the estimated size is within the limit.

    Beyond it ``df`` comes back without a hint: Spark joins by shuffle, and
    adaptive execution splits skewed partitions or still broadcasts if the
    measured size turns out to be below its own threshold.
    """
    limit = DEFAULT_BROADCAST_BYTES if limit_bytes is None else limit_bytes
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
