"""Spark session for scripts and tests; jobs accept any session."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_STORE = "spark.sql.streaming.stateStore"
_PARTITIONS = "spark.sql.shuffle.partitions"

# Stream state on local disk with snapshots in the checkpoint, not on the heap. All stores of an
# executor share one cache with their write buffers. The number of rows in them is not kept: that
# would look up every key before it is written.
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "256",
    f"{_STORE}.rocksdb.compression": "zstd",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}

#: A store has some MB of its own in memory and on disk, whatever it holds, and stays open between
#: batches. What it holds is bounded by neither, so a few large ones do.
STORES_PER_CORE = 4

# Zone-less timestamps make results independent of this; it only fixes how the few
# timestamps with a zone are shown.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STATE,
}


def object_store(endpoint: str, path_style: bool = True, tls: bool = False) -> dict[str, str]:
    """Settings for an S3-compatible store. Credentials come from the environment's
    own provider chain and are never part of the code."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def session(name: str = "tripmill", master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state as ``STATE`` says, in any session, in at
    most ``STORES_PER_CORE`` partitions a core. What the session itself has set of ``STATE`` stays,
    and a checkpoint that is there already keeps its store and its partitions."""
    partitions = min(int(spark.conf.get(_PARTITIONS)), STORES_PER_CORE * spark.sparkContext.defaultParallelism)
    before = {key: spark.conf.get(key, None) for key in (*STATE, _PARTITIONS)}
    inside = {**STATE, **{key: value for key, value in before.items() if value is not None}, _PARTITIONS: str(partitions)}
    for key, value in inside.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
