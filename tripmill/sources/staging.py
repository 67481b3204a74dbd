"""Intermediate tables in the shared folder of the cluster.

A frame that several jobs read, or that must not be recomputed differently after an
executor is lost, is written once and read back. The written table also cuts lineage.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staging_scopes", default=())  # the inner ones last
_local: dict[str, str] = {}  # by application, where the session names no folder
_kept: list[tuple] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a local one only where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local:
            _local[application] = tempfile.mkdtemp(prefix="tripmill-")
        named = _local[application]
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder for the time of this process: what is left in it goes when that ends."""
    path = f"{shared_dir(spark)}/tripmill/{label}-{uuid.uuid4().hex}"
    _kept.append((spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()))
    return path


@atexit.register
def _delete_kept() -> None:
    for path, configuration in _kept:
        try:
            path.getFileSystem(configuration).delete(path, True)
        except Exception:  # the JVM may be gone already
            return


def scoped(path: str, outlives: bool = False) -> str:
    """``path``, which goes with the scope that is open, or, if it ``outlives`` that, with the
    next one around it."""
    scopes = _open_scopes.get()
    if len(scopes) > outlives:
        scopes[-1 - outlives].append(path)
    return path


def staged(df: DataFrame, label: str, codec: str | None = None, outlives: bool = False) -> DataFrame:
    """Write ``df`` to a new staging table and return a scan of it."""
    path = scoped(new_folder(df.sparkSession, label), outlives)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, every table staged inside. Outside a scope the tables stay until
    the process ends, since a returned frame still reads them. Scopes may be nested; what is
    read after the end of the inner one is staged with ``outlives``."""
    created: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), created))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in created:
            delete(spark, path)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` and the path in its terms."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def move(spark: SparkSession, path: str, to: str) -> None:
    """Put the folder ``path`` in place at ``to``, where nothing may be yet."""
    fs, source = file_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    # no folder where there were no rows; one that is there already would take the other in
    if fs.exists(source) and (fs.exists(target) or not fs.rename(source, target)):
        raise OSError(f"{path} can't be moved to {to}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
