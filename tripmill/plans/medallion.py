"""Batch jobs: raw files -> bronze -> silver and quarantine -> gold."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.columns import speed_mph, wall_clock
from tripmill.operators import gold, id_bits, ingest, quality, sketches
from tripmill.operators.dedup import CopyPolicy
from tripmill.operators.quality import Thresholds
from tripmill.schema import DUPLICATE_RANK, REJECT_REASON, SPEED, VALID, ContractError, require_columns, require_types
from tripmill.sources import appends, versions
from tripmill.sources import lake as L
from tripmill.sources.lake import Lake
from tripmill.sources.staging import staged, staging_scope

REVENUE, DURATION, ZONES = "revenue_by_day", "avg_trip_duration", "top_pickup_zones"
#: Partial sums behind ``ZONES``, per partition and zone.
ZONE_PARTS = "pickup_zone_parts"


@dataclass(frozen=True)
class SilverRun:
    """What one silver run read and wrote."""

    bronze_rows: int
    silver_rows: int
    rejection_counts: dict[str, int]

    @property
    def rejected_rows(self) -> int:
        return self.bronze_rows - self.silver_rows

    @property
    def retention_rate_pct(self) -> float | None:
        return self.silver_rows / self.bronze_rows * 100 if self.bronze_rows else None


def write_bronze(raw: DataFrame, lake: Lake, mode: str = "overwrite") -> int:
    """Store raw trips uncleaned by day; returns the row count, seen during the write."""
    if mode == "overwrite":  # what was noted about the rows before
        appends.forget(raw.sparkSession, lake)
        L.delete(raw.sparkSession, lake.index)
    seen = Observation()
    rows = lake.with_partition(ingest.with_trip_date(raw))
    counted = lake.gathered(rows, lake.partition).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode).partitionBy(lake.partition).format(lake.format).option("compression", L.CODEC)
    writer.option("partitionOverwriteMode", "static").save(lake.bronze)
    return seen.get["rows"]


def append_bronze(incoming: DataFrame, lake: Lake, end: date, **options) -> int:
    """Append the rows that are new to bronze (see ``ingest.new_rows``); 0 means no progress.

    The mark up to which rows were taken comes from the log of appends, which has a row per
    append. Where bronze is older than its log, or has none, the mark is found in the last
    partition that has one. Rows are compared with those partitions of bronze alone that
    reach the mark, and with the partition of malformed starts.
    """
    spark = incoming.sparkSession
    if not any("=" in folder for folder in L.subfolders(spark, lake.bronze)):  # nothing is stored yet
        empty = spark.createDataFrame([], incoming.schema)
        fresh = ingest.new_rows(empty, incoming, end, known_mark=(None,), **options)
    else:
        stored = read_bronze(spark, lake)
        known = (appends.mark(spark, lake, stored),)
        fresh = ingest.new_rows(stored, incoming, end, known_mark=known, partition=lake.partition, **options)
    last = Observation()
    at = options.get("at", "trip_start_timestamp")
    seen = fresh.observe(last, F.max(wall_clock(at)).cast("string").alias("mark"))
    name = appends.begin(spark, lake)
    rows = write_bronze(seen, lake, mode="append")
    appends.done(spark, lake, name, last.get["mark"], rows)
    return rows


def read_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.format(lake.format).load(lake.bronze)


def silver_schema(bronze: DataFrame) -> T.StructType:
    """Columns of silver that follow from those of bronze."""
    typed = ingest.typed(bronze).withColumn(SPEED, speed_mph())
    return typed.schema


def quarantine_schema(bronze: DataFrame) -> T.StructType:
    schema = silver_schema(bronze)
    helpers = T.StructType().add(DUPLICATE_RANK, T.LongType()).add(REJECT_REASON, T.StringType())
    return T.StructType(schema.fields + helpers.fields)


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    return versions.read(spark, lake, silver_schema(read_bronze(spark, lake)), valid=True)


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    return versions.read(spark, lake, quarantine_schema(read_bronze(spark, lake)), valid=False)


def affected_partitions(index: DataFrame, changed: DataFrame, partition: str) -> list[date | None]:
    """Partitions whose result may change with ``changed`` rows: their own, and those of
    every row that shares a trip id with them, since copies are ranked across days.
    ``index`` has the pairs (trip_id, partition) of bronze, or is bronze itself."""
    own = [row[0] for row in changed.select(partition).distinct().collect()]
    others = index.filter(~F.coalesce(L.among(partition, own), F.lit(False)))
    if others.isEmpty():
        return own
    ids = changed.select("trip_id").distinct()
    related = others.join(ids, "trip_id", "left_semi").select(partition).distinct()
    return own + [row[0] for row in related.collect()]


def _rows_to_rank(
    bronze: DataFrame, partitions: list, partition: str, index: DataFrame | None, policy: CopyPolicy = CopyPolicy()
) -> DataFrame:
    """Rows of the partitions and, from all others, at least the copies of their trip ids. With
    an index only those other partitions are read that have copies. The copies are found by a
    bitmap of the ids, without a shuffle: that some rows of other ids come along changes no
    rank. Where the ids are too many for it, by a join."""
    chosen = L.among(partition, partitions)
    inside = bronze.filter(chosen)
    outside = bronze.filter(~F.coalesce(chosen, F.lit(False)))
    if outside.isEmpty():
        return inside
    ids = inside.select("trip_id").filter(F.col("trip_id").isNotNull()).distinct()
    if index is not None:
        elsewhere = index.filter(~F.coalesce(chosen, F.lit(False)))
        found = elsewhere.join(ids, "trip_id", "left_semi").select(partition).distinct().collect()
        if not found:
            return inside
        outside = bronze.filter(L.among(partition, [row[0] for row in found]))
    n_rows = inside.count()
    bits = id_bits.bits_for(n_rows, policy.broadcast_bytes)
    if id_bits.false_share(n_rows, bits) <= policy.most_shuffled / 2:
        told = id_bits.marked(outside, "trip_id", id_bits.bitmaps(inside, "trip_id", bits), bits, "_maybe")
        return inside.unionByName(told.filter("_maybe").drop("_maybe"))
    return inside.unionByName(outside.join(ids, "trip_id", "left_semi").select(bronze.columns))


def run_silver(
    spark: SparkSession,
    lake: Lake,
    limits: Thresholds = Thresholds(),
    partitions: list[date | None] | None = None,
    tie_break: tuple[str, ...] | None = None,
    dedup_after_validation: bool = False,
    policy: CopyPolicy = CopyPolicy(),
    run_id: str | None = None,
    index: DataFrame | None = None,
) -> SilverRun:
    """Clean bronze into silver and quarantine, for everything or for some partitions.
    A run that is repeated under its ``run_id`` leaves one row of metrics.

    All tagged rows go to a folder of this run in one write, are counted as read back and
    held against bronze, and then come into force together by the rename of one small file
    (see ``versions``). A run that stops at any point leaves the tables as they were, so
    bronze = silver + quarantine holds per partition at all times. ``index`` has the pairs
    (trip_id, partition) of bronze, by which copies outside ``partitions`` are found.
    """
    bronze = require_columns(read_bronze(spark, lake))
    if bronze.isEmpty():
        raise ContractError("bronze has no rows")
    column = lake.partition
    before = versions.current(spark, lake)
    policy = replace(policy, stored=True)
    with staging_scope(spark):
        rows = bronze if partitions is None else _rows_to_rank(bronze, partitions, column, index, policy)
        tagged = quality.tagged(rows, limits, tie_break, dedup_after_validation, policy)
        require_types(tagged)
        if partitions is not None:
            bronze = bronze.filter(L.among(column, partitions))
            tagged = tagged.filter(L.among(column, partitions))
        written = versions.write(tagged, lake)
    try:
        run = _run_of(written.counts)
        if partitions is None and run.silver_rows == 0:
            raise ContractError("no row is valid; nothing was published")
        _reconciled(bronze, lake, written)
        scope = None if partitions is None else {versions.partition_of(v, lake) for v in partitions}
        versions.publish(spark, lake, before.replaced(written.run, written.counts, scope))
    except BaseException:
        versions.discard(spark, lake, written.run)
        raise
    if not written.counts:
        versions.discard(spark, lake, written.run)
    L.write_metrics(spark, lake, _metrics_row(run, lake, run_id or uuid.uuid4().hex))
    versions.vacuum(spark, lake)
    return run


def _run_of(counts: dict[str, dict[str, int]]) -> SilverRun:
    per_reason: dict[str, int] = {}
    for reasons in counts.values():
        for why, n in reasons.items():
            per_reason[why] = per_reason.get(why, 0) + n
    valid = per_reason.pop(VALID, 0)
    return SilverRun(valid + sum(per_reason.values()), valid, per_reason)


def _reconciled(bronze: DataFrame, lake: Lake, written: versions.Written) -> None:
    """Raise unless every partition of bronze was written whole. Bronze is counted by its
    files' footers."""
    expected = {versions.partition_of(v, lake): n for v, n in bronze.groupBy(lake.partition).count().collect()}
    found = {p: sum(counts.values()) for p, counts in written.counts.items()}
    wrong = {p: (found.get(p, 0), expected.get(p, 0)) for p in {*found, *expected} if found.get(p, 0) != expected.get(p, 0)}
    if wrong:
        shown = "; ".join(f"{p}: {got} written, {n} in bronze" for p, (got, n) in sorted(wrong.items()))
        raise ContractError(f"silver and quarantine don't add up to bronze: {shown}")


def _metrics_row(run: SilverRun, lake: Lake, run_id: str) -> dict:
    return {
        "run_id": run_id,
        "finished_at": datetime.now(timezone.utc).replace(tzinfo=None),
        "bronze_rows": run.bronze_rows,
        "silver_rows": run.silver_rows,
        "rejected_rows": run.rejected_rows,
        "retention_rate_pct": run.retention_rate_pct,
        "rejection_counts": run.rejection_counts,
        "silver_path": lake.silver,
        "quarantine_path": lake.silver,
    }


def metrics_history(metrics: DataFrame) -> DataFrame:
    """Each run next to the change since the run before it on the same silver table."""
    runs = Window.partitionBy("silver_path").orderBy("finished_at", "run_id")
    changes = {
        f"{name}_change": F.col(name) - F.lag(name).over(runs)
        for name in ("bronze_rows", "silver_rows", "rejected_rows", "retention_rate_pct")
    }
    return metrics.withColumns(changes)


def reconcile(spark: SparkSession, lake: Lake) -> DataFrame:
    """Partitions whose stored bronze rows are not all in silver or quarantine."""
    tables = read_bronze(spark, lake), read_silver(spark, lake), read_quarantine(spark, lake)
    return quality.reconciliation(*tables, by=lake.partition).filter(F.col("difference") != 0)


def replay_quarantine(spark: SparkSession, lake: Lake, limits: Thresholds) -> DataFrame:
    return quality.replay(read_quarantine(spark, lake), limits)


def run_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Write all gold tables; returns the rows of each."""
    silver = read_silver(spark, lake)
    return {
        REVENUE: L.write_gold(gold.revenue_by(silver), lake.gold(REVENUE), "trip_date"),
        DURATION: L.write_gold(gold.duration_by(silver), lake.gold(DURATION), "trip_date"),
        ZONES: _refresh_zones(spark, lake, silver, None),
    }


def refresh_gold(spark: SparkSession, lake: Lake, partitions: list[date | None]) -> dict[str, int]:
    """Recompute the gold rows of some partitions; returns the rows of each table. Silver is
    read for those partitions only: zones are rolled up from partial sums per partition."""
    written = {}
    silver = read_silver(spark, lake)
    chosen = L.among(lake.partition, partitions)
    for table, build in ((REVENUE, gold.revenue_by), (DURATION, gold.duration_by)):
        fresh = build(silver.filter(chosen))
        stored = lake.with_partition(L.read(spark, lake.gold(table), fresh.schema))
        kept = stored.filter(~F.coalesce(L.among(lake.partition, partitions), F.lit(False)))
        rows = kept.select(fresh.columns).unionByName(fresh)
        written[table] = L.replace_table(rows, lake.gold(table), "trip_date")
    missing = not L.exists(spark, lake.gold(ZONE_PARTS))
    return {**written, ZONES: _refresh_zones(spark, lake, silver, None if missing else partitions)}


def _refresh_zones(spark: SparkSession, lake: Lake, silver: DataFrame, partitions: list | None) -> int:
    """Replace the partial sums of some partitions (None: of all) and roll all of them up."""
    path, column = lake.gold(ZONE_PARTS), lake.partition
    chosen = silver if partitions is None else silver.filter(L.among(column, partitions))
    parts = gold.zone_parts(chosen, column)
    if partitions is None:
        parts.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)
    else:
        with staging_scope(spark):
            parts = staged(parts, "zone-parts")
            L.overwrite_partitions(parts, path, [column])
            filled = {versions.partition_of(row[0], lake) for row in parts.select(column).distinct().collect()}
        for folder in {versions.partition_of(v, lake) for v in partitions} - filled:
            L.delete(spark, f"{path}/{folder}")
    rolled = gold.zones_of(L.read(spark, path, parts.schema))
    return L.write_gold(rolled, lake.gold(ZONES), F.desc("nb_trips"), "pickup_community_area")


def write_sketches(spark: SparkSession, lake: Lake, partitions: list[date | None] | None = None) -> None:
    """Store the sketches of silver by day, for all partitions or some, which are replaced."""
    silver = read_silver(spark, lake)
    chosen = silver if partitions is None else silver.filter(L.among(lake.partition, partitions))
    found = lake.with_partition(sketches.by_day(chosen))
    if partitions is None:
        found.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(lake.partition).parquet(lake.sketches)
        return
    L.overwrite_partitions(found, lake.sketches, [lake.partition])
    filled = {versions.partition_of(v, lake) for v, in chosen.select(lake.partition).distinct().collect()}
    for folder in {versions.partition_of(v, lake) for v in partitions} - filled:
        L.delete(spark, f"{lake.sketches}/{folder}")


def read_sketches(spark: SparkSession, lake: Lake) -> DataFrame:
    schema = lake.with_partition(sketches.by_day(read_silver(spark, lake))).schema
    return L.read(spark, lake.sketches, schema)


def run_all(spark: SparkSession, raw: DataFrame, lake: Lake, **silver_options) -> SilverRun:
    write_bronze(raw, lake)
    run = run_silver(spark, lake, **silver_options)
    run_gold(spark, lake)
    return run
