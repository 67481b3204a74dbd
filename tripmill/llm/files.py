"""Files that tasks write themselves, and range shards for them.

A task writes to a temporary name and renames the finished file, so a file under its final
name is always whole, and a second attempt of the task replaces it by the same bytes. What
counts is listed in a manifest; anything else in the folder is ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of the key sample per shard; the sample fixes where shards begin and nothing else.
SAMPLE_PER_SHARD = 64
#: Most range shards. Beyond them shards grow with the table, so that the driver holds a
#: sample of some 4 million keys (32 MB) at most, however large the table is.
MOST_SHARDS = 1 << 16


def qualified(spark: SparkSession, path: str) -> str:
    """URI of ``path``, the same for the driver and the tasks."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


@contextmanager
def committed(folder: str, name: str) -> Iterator:
    """Stream to a temporary file that gets its name when the block ends well."""
    fs, base = pafs.FileSystem.from_uri(folder)
    temporary = f"{base}/_temporary/{name}.{uuid.uuid4().hex}"
    fs.create_dir(f"{base}/_temporary", recursive=True)
    try:
        with fs.open_output_stream(temporary) as out:
            yield out
    except BaseException:
        fs.delete_file(temporary)
        raise
    fs.move(temporary, f"{base}/{name}")


def opened(folder: str, name: str):
    fs, base = pafs.FileSystem.from_uri(folder)
    return fs.open_input_file(f"{base}/{name}")


def shard_bounds(df: DataFrame, key: str, shards: int, rows: int) -> np.ndarray:
    """Keys at which the second and later of about equal range shards begin.

    A function of the keys alone, so a second run cuts alike: keys whose hash falls into
    a fixed class are the sample, about ``SAMPLE_PER_SHARD`` per shard. There are at most
    ``MOST_SHARDS`` shards. Null keys count for nothing; without any key there is one shard.
    """
    shards = min(shards, MOST_SHARDS)
    if shards < 2:
        return np.zeros(0, np.int64)
    every = max(1, rows // (shards * SAMPLE_PER_SHARD))
    chosen = df.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).where(F.col(key).isNotNull())
    # a key repeated very often counts once, which keeps the sample small
    found = chosen.select(F.col(key).cast("long").alias("key")).distinct().toArrow().column("key")
    keys = np.sort(found.to_numpy())
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.unique(keys[(np.arange(1, shards) * len(keys)) // shards])
