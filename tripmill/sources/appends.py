"""Log of what was appended to bronze: a row per append, read instead of bronze."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators import ingest
from tripmill.sources.lake import HIVE_NULL, Lake, read, subfolders
from tripmill.sources.staging import delete

LOG = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("done", T.BooleanType()),
        T.StructField("mark", T.StringType()),  # latest trip start of the append, if it had any
        T.StructField("rows", T.LongType()),
        T.StructField("at", T.TimestampNTZType()),
    ]
)


def log(spark: SparkSession, lake: Lake) -> DataFrame:
    return read(spark, lake.append_log, LOG)


def _add(spark: SparkSession, lake: Lake, *row) -> None:
    row = (*row, datetime.now(timezone.utc).replace(tzinfo=None))
    spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(lake.append_log)


def begin(spark: SparkSession, lake: Lake) -> str:
    """Note that rows are about to be appended. While an append is not noted as done, the
    log says nothing on what is stored."""
    name = uuid.uuid4().hex
    _add(spark, lake, name, False, None, 0)
    return name


def done(spark: SparkSession, lake: Lake, name: str, mark: str | None, rows: int) -> None:
    _add(spark, lake, name, True, mark, rows)


def forget(spark: SparkSession, lake: Lake) -> None:
    delete(spark, lake.append_log)


def mark(spark: SparkSession, lake: Lake, bronze: DataFrame, at: str = "trip_start_timestamp") -> datetime | None:
    """Latest trip start in bronze.

    Normally from the log. Where that is gone, was never kept, or has an append that was
    stopped, from the last partition that has a start; no other partition is read, and the
    log begins anew with what was found.
    """
    ids = log(spark, lake).groupBy("id").agg(F.max("done").alias("done"), F.max(F.col("mark").try_cast("timestamp_ntz")).alias("mark"))
    n, whole, latest = ids.agg(F.count(F.lit(1)), F.min("done"), F.max("mark")).first()
    if n and whole:
        return latest
    forget(spark, lake)
    found = _latest(spark, lake, bronze, at)
    done(spark, lake, begin(spark, lake), found and str(found), 0)
    return found


def _latest(spark: SparkSession, lake: Lake, bronze: DataFrame, at: str) -> datetime | None:
    prefix = f"{lake.partition}="
    days = sorted((d.removeprefix(prefix) for d in subfolders(spark, lake.bronze) if d.startswith(prefix)), reverse=True)
    for day in days:
        if day != HIVE_NULL:
            latest = ingest.high_water_mark(bronze.filter(F.col(lake.partition) == F.lit(day).cast("date")), at)
            if latest is not None:
                return latest
    return None
