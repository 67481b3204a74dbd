"""On which partitions of bronze the rows of each trip id are.

Two narrow columns, appended per batch in a folder of the batch's name, sorted by id so that
file statistics help to find some ids. An incremental run asks the index instead of bronze
for the copies of its ids. A batch that is run again replaces its own folder. Pairs may be
there twice, or more of them than needed; none may be missing.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.lake import Lake, exists, subfolders
from tripmill.sources.staging import delete

#: Folders of batches after which they are put together.
MOST_BATCHES = 64
_BASE = "batch=base"


def _pairs(rows: DataFrame, lake: Lake) -> DataFrame:
    pairs = rows.select("trip_id", lake.partition).filter(F.col("trip_id").isNotNull())
    # equal pairs are in one range: no second shuffle
    return pairs.repartitionByRange("trip_id").distinct().sortWithinPartitions("trip_id")


def read(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows (trip_id, partition)."""
    return spark.read.schema(f"trip_id string, {lake.partition} date").parquet(lake.index).select("trip_id", lake.partition)


def rebuild(spark: SparkSession, lake: Lake, bronze: DataFrame) -> None:
    """Index all of bronze anew, from two of its columns."""
    _pairs(bronze, lake).write.mode("overwrite").parquet(f"{lake.index}/{_BASE}")
    for folder in subfolders(spark, lake.index) - {_BASE}:
        delete(spark, f"{lake.index}/{folder}")


def append(spark: SparkSession, lake: Lake, batch: DataFrame, name: str) -> None:
    """Add the rows of a batch of bronze."""
    _pairs(batch, lake).write.mode("overwrite").parquet(f"{lake.index}/batch={sha256(name.encode()).hexdigest()}")
    batches = subfolders(spark, lake.index)
    if len(batches) > MOST_BATCHES:  # first written whole, then deleted: pairs may be there twice
        merged = f"batch=merged-{sha256(name.encode()).hexdigest()}"
        _pairs(read(spark, lake), lake).write.mode("overwrite").parquet(f"{lake.index}/{merged}")
        for folder in batches - {merged}:
            delete(spark, f"{lake.index}/{folder}")


def ensure(spark: SparkSession, lake: Lake, bronze: DataFrame) -> bool:
    """Index all of ``bronze`` where there is no index yet; returns whether that was so."""
    if exists(spark, lake.index):
        return False
    rebuild(spark, lake, bronze)
    return True
