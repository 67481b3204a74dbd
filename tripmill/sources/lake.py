"""Stored tables: bronze, silver and quarantine by day, gold, run metrics."""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import RUN_METRICS
from tripmill.sources.staging import delete, file_system, staged, staging_scope

HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
GRAINS = {"day": "trip_date", "month": "trip_month", "year": "trip_year"}
FILE_FORMATS = ("parquet", "orc")
CODEC = "zstd"


@dataclass(frozen=True)
class Lake:
    """Paths below ``root``, the partitioning grain and the file format.

    ``grain`` is 'day' (partition column ``trip_date``), 'month' (``trip_month``, the first
    day of the month) or 'year' (``trip_year``), for volumes at which a day would be a
    tiny file. ``format`` is that of the partitioned tables; stale partitions are cleared
    as folders, so it must be a plain file format. They are compressed with zstd, which takes
    a fifth less than the default codec of Parquet.
    """

    root: str
    grain: str = "day"
    format: str = "parquet"

    def __post_init__(self):
        if self.grain not in GRAINS or self.format not in FILE_FORMATS:
            raise ValueError(f"grain must be one of {list(GRAINS)}, format one of {list(FILE_FORMATS)}")

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def bronze(self) -> str:
        return self.path("bronze/trips")

    @property
    def silver(self) -> str:
        """Silver and quarantine: runs that wrote them and versions that say which count."""
        return self.path("silver")

    @property
    def index(self) -> str:
        return self.path("index/trip_partitions")

    @property
    def sketches(self) -> str:
        return self.path("gold/sketches_by_partition")

    @property
    def append_log(self) -> str:
        return self.path("bronze/appends")

    @property
    def metrics(self) -> str:
        return self.path("run_metrics")

    def gold(self, table: str) -> str:
        return self.path(f"gold/{table}")

    @property
    def partition(self) -> str:
        return GRAINS[self.grain]

    @property
    def gathers(self) -> bool:
        """Whether rows are shuffled by partition before they are written. Years are few, so
        there every task writes a file of its own to each instead, and no row is shuffled."""
        return self.grain != "year"

    def gathered(self, df: DataFrame, *by: str) -> DataFrame:
        return df.hint("rebalance", *by) if self.gathers else df

    def with_partition(self, df: DataFrame) -> DataFrame:
        if self.grain == "day":
            return df
        return df.withColumn(self.partition, F.trunc("trip_date", self.grain))


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def read(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """Table at ``path``, with no rows where nothing was written yet.

    The explicit schema also covers a table whose last write had no rows.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(format).load(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str], format: str = "parquet") -> None:
    """Replace the partitions that ``df`` has rows for and leave the others alone.

    The mode is set for this write only. The rebalance spreads a large partition over
    several even files and gathers a small one, instead of one file per task and day.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(format)
        .save(path)
    )


def partition_folder(column: str, value: date | str | None) -> str:
    return f"{column}={HIVE_NULL if value is None else value}"


def subfolders(spark: SparkSession, path: str) -> set[str]:
    """Names of the partition folders directly below ``path``; reads no data file."""
    if not exists(spark, path):
        return set()
    fs, p = file_system(spark, path)
    return {entry.getPath().getName() for entry in fs.listStatus(p) if entry.isDirectory()}


def write_gold(df: DataFrame, path: str, *order) -> int:
    """One sorted file: gold has one row per day or zone. Returns the row count, seen
    during the write."""
    seen = Observation()
    rows = df.orderBy(*order).coalesce(1).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def replace_table(df: DataFrame, path: str, *order) -> int:
    """``write_gold`` for a result that is computed from the table it replaces."""
    with staging_scope(df.sparkSession):
        return write_gold(staged(df, "replace"), path, *order)


def register_gold(spark: SparkSession, lake: Lake, tables: list[str]) -> None:
    """Expose gold tables to SQL under their names."""
    for table in tables:
        spark.read.parquet(lake.gold(table)).createOrReplaceTempView(table)


def write_metrics(spark: SparkSession, lake: Lake, row: dict) -> None:
    """Store the row of a run in a folder named after the run, so one that is repeated, or
    two at a time, leave one row."""
    name = sha256(row["run_id"].encode()).hexdigest()
    spark.createDataFrame([row], RUN_METRICS).coalesce(1).write.mode("overwrite").parquet(f"{lake.metrics}/run={name}")


def read_metrics(spark: SparkSession, lake: Lake) -> DataFrame:
    return read(spark, lake.metrics, RUN_METRICS).select(RUN_METRICS.names)


def among(column: str, values: list):
    """Membership test that also finds NULL when it is among ``values``."""
    present = F.col(column).isin([v for v in values if v is not None])
    return present | F.col(column).isNull() if None in values else present
