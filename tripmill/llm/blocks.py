"""Blocks of texts that stay where they are written.

A block is a bounded run of texts that one task has read. Its rows are written bucketed by
block number, so later joins and cogroups by block shuffle the other side only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tripmill.sources.staging import new_folder, scoped


def buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Texts that go to a Python process at a time while blocks are made.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer texts per Arrow batch for the jobs inside, which bounds the memory of both
    processes of a task; the session's own setting comes back afterwards."""
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_ROWS, before)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job inside are deleted when it ends, not when the driver happens to
    collect its garbage; the session's own setting comes back afterwards. For jobs that write
    tables, as frames that are run again would have to repeat their stages."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


#: Rows of a file, about, where a table of slim rows is written.
ROWS_PER_FILE = 50_000


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions as ``rows`` slim rows need, however many the shuffle before
    has: a small table isn't scattered over hundreds of tiny files."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))


def bucketed(df: DataFrame, by: str, label: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``by``, and read from there. Goes with
    the staging scope that is open, if there is one."""
    spark = df.sparkSession
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.bucketBy(buckets(df), by).option("path", scoped(new_folder(spark, label))).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external one: its files stay and the frame reads them
    return table
