"""Registered queries: every operator over the whole trip view of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators import dedup, enrich, gold, ingest, profile, quality, serve, sketches
from tripmill.operators.quality import Thresholds
from tripmill.plans import medallion
from tripmill.session import state_on_disk
from tripmill.sources.files import read_raw_csv, write_csv
from tripmill.sources.lake import CODEC, Lake, read_metrics, register_gold
from tripmill.sources.staging import move, new_folder, staged
from tripmill.sources.trips_view import TIE_BREAK, areas, trips
from tripmill.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = (date(1995, 3, 1), date(1996, 8, 31))
RELAXED = Thresholds(max_seconds=22000, max_miles=200.0, max_speed_mph=250.0)
EVENTS = [
    ("Harbour Run", date(1995, 10, 8), date(1995, 10, 8)),
    ("Summer Fair", date(1996, 8, 3), date(1996, 8, 6)),
    ("Fair Opening", date(1996, 8, 3), date(1996, 8, 3)),
]


def typed_trips(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.typed(trips(spark, folder))


def stored_trips(spark: SparkSession, folder: str) -> DataFrame:
    """The trips written once, for operators that read their source several times."""
    return staged(trips(spark, folder), "trips", CODEC)


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    return quality.tagged(trips(spark, folder), tie_break=TIE_BREAK)


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return quality.silver(trips(spark, folder), tie_break=TIE_BREAK)


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    return gold.revenue_by(silver(spark, folder))


def duration(spark: SparkSession, folder: str) -> DataFrame:
    return gold.duration_by(silver(spark, folder))


def zones(spark: SparkSession, folder: str) -> DataFrame:
    return gold.pickup_zones(silver(spark, folder))


def _of(source: Query, operator: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, folder: operator(source(spark, folder), *args, **options)


def ingest_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The trips landed as CSV text, read back as text and typed."""
    path = new_folder(spark, "csv")
    trips(spark, folder).drop("trip_date", "l_quantity", "l_extendedprice").write.option("header", True).csv(path)
    return ingest.typed(ingest.with_trip_date(read_raw_csv(spark, path)))


def incremental_append(spark: SparkSession, folder: str) -> DataFrame:
    """A table stored up to noon of a day is grown to the end of 1998."""
    rows = trips(spark, folder)
    noon = F.lit("1996-06-30 12:00:00").cast("timestamp_ntz")
    stored = rows.filter(F.col("trip_start_timestamp") < noon)
    return ingest.appended(stored, rows, end=date(1998, 12, 31))


def incremental_whole(spark: SparkSession, folder: str) -> DataFrame:
    """The same up to the last day there is, the days before the mark included."""
    rows = trips(spark, folder)
    noon = F.lit("1996-06-30 12:00:00").cast("timestamp_ntz")
    return ingest.appended(rows.filter(F.col("trip_start_timestamp") < noon), rows, end=date(2100, 1, 1))


def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.reconciliation_of(trips(spark, folder), tagged(spark, folder))


def kpi_cards(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver(spark, folder)
    return serve.kpi_cards(gold.revenue_by(rows), gold.duration_by(rows))


def zone_names(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.with_zone_names(serve.zones(zones(spark, folder)), areas(spark, folder))


def zone_map(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.zone_map(serve.zones(zones(spark, folder)), areas(spark, folder))


def event_days(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.createDataFrame(EVENTS, enrich.EVENTS_SCHEMA)
    return enrich.with_event_names(serve.revenue_by_day(revenue(spark, folder)), events)


def _stored(spark: SparkSession, folder: str) -> Lake:
    """A lake in a new folder: all of bronze, a full run, then a rerun of two years."""
    lake = Lake(new_folder(spark, "lake"), grain="year")
    medallion.write_bronze(trips(spark, folder), lake)
    medallion.run_silver(spark, lake, tie_break=TIE_BREAK)
    medallion.run_silver(spark, lake, tie_break=TIE_BREAK, partitions=[date(1995, 1, 1), date(1997, 1, 1)])
    return lake


def stored_silver(spark: SparkSession, folder: str) -> DataFrame:
    return medallion.read_silver(spark, _stored(spark, folder))


def stored_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return medallion.read_quarantine(spark, _stored(spark, folder))


def stored_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    lake = _stored(spark, folder)
    tables = (read(spark, lake) for read in (medallion.read_bronze, medallion.read_silver, medallion.read_quarantine))
    return quality.reconciliation(*tables, by=lake.partition)


def stored_duration(spark: SparkSession, folder: str) -> DataFrame:
    """Daily gold written from stored silver, one year of it recomputed, read as a table."""
    lake = _stored(spark, folder)
    medallion.run_gold(spark, lake)
    medallion.refresh_gold(spark, lake, [date(1996, 1, 1)])
    return spark.read.parquet(lake.gold(medallion.DURATION))


def _stored_gold(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """A gold table written from stored silver, read by its name in SQL."""
        lake = Lake(new_folder(spark, "lake"), grain="year")
        medallion.run_all(spark, trips(spark, folder), lake, tie_break=TIE_BREAK)
        register_gold(spark, lake, [table])
        return spark.sql(f"SELECT * FROM {table}")

    return query


def stored_metrics(spark: SparkSession, folder: str) -> DataFrame:
    history = medallion.metrics_history(read_metrics(spark, _stored(spark, folder)))
    return history.select(
        "bronze_rows",
        "silver_rows",
        "rejected_rows",
        F.col("rejection_counts")["null_trip_id"].alias("null_ids"),
        "retention_rate_pct",
        "bronze_rows_change",
        "silver_rows_change",
        "rejected_rows_change",
        "retention_rate_pct_change",
    )


def revenue_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The exported file of a period, read back as text."""
    path = new_folder(spark, "export")
    write_csv(serve.revenue_by_day(revenue(spark, folder), *PERIOD), path)
    text = read_raw_csv(spark, path)
    return text.withColumns({c: F.col(c).cast("double") for c in ("total_revenue", "avg_trip_total")})


def _landed(spark: SparkSession, folder: str) -> tuple[DataFrame, Lake]:
    """The trips as landed files, as a stream, and a new lake beside them."""
    lake = Lake(new_folder(spark, "stream"), grain="year")
    rows = trips(spark, folder)
    landing = lake.path("landing")
    rows.write.mode("append").option("compression", CODEC).parquet(landing)
    return jobs.landed_files(spark, landing, rows.schema), lake


def stream_silver(spark: SparkSession, folder: str) -> DataFrame:
    stream, lake = _landed(spark, folder)
    jobs.land_bronze(stream, lake, lake.path("checkpoints/bronze")).awaitTermination()
    jobs.refresh_silver(spark, lake, lake.path("checkpoints/silver"), tie_break=TIE_BREAK).awaitTermination()
    return medallion.read_silver(spark, lake)


def _streamed_gold(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """Daily gold of clean trips after two arrivals, the second late on all days."""
        lake, rows = Lake(new_folder(spark, "stream"), grain="year"), trips(spark, folder)
        second = F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == 0
        arrivals = rows.withColumn("second", second).write.partitionBy("second").option("compression", CODEC)
        arrivals.parquet(lake.path("arrivals"))
        for arrival in ("second=false", "second=true"):
            move(spark, lake.path(f"arrivals/{arrival}"), lake.path(f"landing/{arrival}"))
            stream = jobs.landed_files(spark, lake.path("landing/*"), rows.schema)
            jobs.land_bronze(stream, lake, lake.path("checkpoints/bronze")).awaitTermination()
            jobs.refresh_silver(
                spark, lake, lake.path("checkpoints/silver"), with_gold=True, tie_break=TIE_BREAK
            ).awaitTermination()
        return spark.read.parquet(lake.gold(table))

    return query


def _drained(stream: DataFrame, lake: Lake, name: str) -> DataFrame:
    """Run a stream until all landed files are through and return what it wrote."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", lake.path(name))
        .option("checkpointLocation", lake.path(f"checkpoints/{name}"))
        .trigger(availableNow=True)
    )
    with state_on_disk(stream.sparkSession):
        query = writer.start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(lake.path(name))


def stream_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """Which copy comes first is a matter of arrival, so only the ids are shown."""
    stream, lake = _landed(spark, folder)
    return _drained(jobs.first_seen(stream, "3650 days").select("trip_id"), lake, "first_seen")


def stream_landed_totals(spark: SparkSession, folder: str) -> DataFrame:
    """What landed per day, up to the day that the watermark has passed."""
    stream, lake = _landed(spark, folder)
    return _drained(jobs.landed_totals(stream), lake, "landed_totals")


def sketched_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Distributions of a period from stored sketches per day: exact counts and bounds, and
    whether all percentiles keep to the stated error of their ranks."""
    lake = Lake(new_folder(spark, "lake"), grain="year")
    medallion.run_all(spark, trips(spark, folder), lake, tie_break=TIE_BREAK)
    medallion.write_sketches(spark, lake)
    found = sketches.percentiles(sketches.merged(medallion.read_sketches(spark, lake), *PERIOD))
    inside = medallion.read_silver(spark, lake).filter(F.col("trip_date").between(*map(F.lit, PERIOD)))
    errors = sketches.rank_errors(inside, found)
    return errors.select("measure", "n", "minimum", "maximum", (F.col("rank_error") <= sketches.RANK_ERROR).alias("within_error"))


def sketched_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct ids of a period of raw trips from sketches per day, and whether the count keeps
    to the stated error."""
    rows = typed_trips(spark, folder)
    stored = staged(sketches.by_day(rows), "sketches")
    found = sketches.distinct_ids(sketches.merged(stored, *PERIOD))
    inside = rows.filter(F.col("trip_date").between(*map(F.lit, PERIOD)))
    exact = inside.agg(F.count_distinct("trip_id").alias("exact"), F.count("*").alias("rows"))
    near = F.abs(F.col("distinct_trip_id") - F.col("exact")) <= F.col("exact") * sketches.COUNT_ERROR
    return found.join(exact, "rows").select("rows", "null_trip_id", near.alias("within_error"))


def duration_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Daily durations with sketched percentiles; days are small enough for those to be exact."""
    return gold.duration_by_approx(silver(spark, folder))


def event_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Bands of the events that overlap the days of the revenue table."""
    events = spark.createDataFrame(EVENTS, enrich.EVENTS_SCHEMA)
    bounds = serve.period_bounds(revenue(spark, folder)).first()
    return enrich.event_bands(events, *bounds)


def not_taken(spark: SparkSession, folder: str) -> DataFrame:
    """What an append up to the end of 1997 leaves out, beside a table stored up to a noon."""
    rows = trips(spark, folder)
    noon = F.lit("1996-06-30 12:00:00").cast("timestamp_ntz")
    return ingest.not_taken(rows.filter(F.col("trip_start_timestamp") < noon), rows, end=date(1997, 12, 31))


def appended_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze after appends without rows, with some and with the same again, by the log of appends."""
    lake, rows = Lake(new_folder(spark, "appends"), grain="year"), trips(spark, folder)
    for end in (date(1990, 1, 1), date(1995, 6, 30), date(1995, 6, 30), date(1996, 6, 30), date(2100, 1, 1)):
        medallion.append_bronze(rows.drop("trip_date"), lake, end)
    return medallion.read_bronze(spark, lake).groupBy("trip_date").agg(F.count("*").alias("nb_trips"))


def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals; trips of the second that began over a year before the latest of the first
    are late. What landed per day, on time and late."""
    lake, rows = Lake(new_folder(spark, "late")), trips(spark, folder)
    second = F.col("l_partkey") % 3 == 0
    on_time, late = lake.path("on_time"), lake.path("late")
    for arrival in (~second, second):
        rows.filter(arrival).write.mode("append").parquet(lake.path("landing"))
        stream = jobs.landed_files(spark, lake.path("landing"), rows.schema)
        jobs.split_late(stream, on_time, late, lake.path("marks"), lake.path("checkpoint"), timedelta(days=365)).awaitTermination()
    sides = [spark.read.schema(rows.schema).parquet(path).withColumn("late", F.lit(flag)) for path, flag in ((on_time, False), (late, True))]
    return sides[0].unionByName(sides[1]).groupBy("trip_date").agg(
        F.count("*").alias("landed"), F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late")
    )


def stream_first_seen_expired(spark: SparkSession, folder: str) -> DataFrame:
    """The newest copies of all trips arrive, then all again ten years later, when the state of the first has
    expired but for those of the last two days: the others come back."""
    lake, rows = Lake(new_folder(spark, "expired")), dedup.latest(trips(spark, folder), tie_break=TIE_BREAK)
    start, landed = "trip_start_timestamp", staged(rows, "newest", CODEC)
    again = landed.withColumn(start, F.timestamp_add("DAY", F.lit(3650), F.col(start)))
    for arrival in (landed, again):
        arrival.write.mode("append").option("compression", CODEC).parquet(lake.path("landing"))
        stream = jobs.landed_files(spark, lake.path("landing"), rows.schema)
        found = _drained(jobs.first_seen(stream, "1 day").select("trip_id"), lake, "first_seen")
    return found.groupBy("trip_id").agg(F.count("*").alias("times"))


def all_queries() -> dict[str, Query]:
    return {
        "ingest_typed": typed_trips,
        "ingest_csv": ingest_csv,
        "incremental_append": incremental_append,
        "incremental_whole": incremental_whole,
        "quality_tagged": tagged,
        "quality_silver": silver,
        "quality_quarantine": _of(tagged, quality.quarantine_of),
        "quality_reject_counts": _of(tagged, quality.reason_counts),
        "quality_retention": _of(_of(tagged, quality.reason_counts), quality.retention),
        "quality_reconcile": reconcile,
        "quality_checks": _of(tagged, quality.checks),
        "quality_replay": _of(_of(tagged, quality.quarantine_of), quality.replay, RELAXED),
        "quality_dedup_after_validation": _of(
            stored_trips, quality.tagged, tie_break=TIE_BREAK, dedup_after_validation=True
        ),
        "dedup_ranked": _of(typed_trips, dedup.ranked, tie_break=TIE_BREAK),
        "dedup_latest": _of(typed_trips, dedup.latest, tie_break=TIE_BREAK),
        "gold_revenue_by_day": lambda s, d: revenue(s, d).orderBy("trip_date"),
        "gold_avg_trip_duration": lambda s, d: duration(s, d).orderBy("trip_date"),
        "gold_top_pickup_zones": lambda s, d: zones(s, d).orderBy(F.desc("nb_trips"), "pickup_community_area"),
        "kpi_global": _of(revenue, serve.global_kpis),
        "kpi_duration": _of(duration, serve.global_duration),
        "kpi_cards": kpi_cards,
        "global_average_duration": _of(duration, serve.global_average_duration),
        "period_bounds": _of(revenue, serve.period_bounds),
        "revenue_between": _of(revenue, serve.revenue_by_day, *PERIOD),
        "duration_between": _of(duration, serve.duration_by_day, *PERIOD),
        "top_revenue_days": _of(revenue, serve.top_revenue_days),
        "top_trip_days": _of(revenue, serve.top_trip_days),
        "longest_avg_duration_days": _of(duration, serve.longest_average_duration_days),
        "highest_p90_days": _of(duration, serve.highest_p90_duration_days),
        "zones_all": _of(zones, serve.zones),
        "top_zones_by_trips": _of(zones, serve.top_zones_by_trips),
        "top_zones_by_revenue": _of(zones, serve.top_zones_by_revenue),
        "zone_activity_vs_revenue": _of(zones, serve.zone_activity_vs_revenue),
        "zone_activity_top20": _of(zones, serve.zone_activity_vs_revenue, limit=20),
        "profile_identity": _of(typed_trips, profile.identity),
        "profile_duration": _of(typed_trips, profile.duration),
        "profile_distance": _of(typed_trips, profile.distance),
        "profile_speed": _of(typed_trips, profile.speed),
        "profile_distributions": _of(typed_trips, profile.distributions),
        "extreme_distances": _of(typed_trips, profile.extreme_distances),
        "extreme_speeds": _of(typed_trips, profile.extreme_speeds),
        "zone_names": zone_names,
        "zone_map": zone_map,
        "event_days": event_days,
        "duration_long": _of(duration, enrich.duration_long),
        "revenue_display": _of(_of(revenue, serve.revenue_by_day), enrich.pretty),
        "revenue_csv": revenue_csv,
        "stored_silver": stored_silver,
        "stored_duration": stored_duration,
        "stored_revenue": _stored_gold(medallion.REVENUE),
        "stored_zones": _stored_gold(medallion.ZONES),
        "stored_metrics": stored_metrics,
        "stored_quarantine": stored_quarantine,
        "stored_reconcile": stored_reconcile,
        "stream_silver": stream_silver,
        "stream_first_seen": stream_first_seen,
        "stream_landed_totals": stream_landed_totals,
        "stream_gold_revenue": _streamed_gold(medallion.REVENUE),
        "stream_gold_duration": _streamed_gold(medallion.DURATION),
        "stream_gold_zones": _streamed_gold(medallion.ZONES),
        "stream_late_rows": stream_late_rows,
        "stream_first_seen_expired": stream_first_seen_expired,
        "sketched_profile": sketched_profile,
        "sketched_ids": sketched_ids,
        "duration_approx": duration_approx,
        "event_bands": event_bands,
        "ingest_not_taken": not_taken,
        "appended_bronze": appended_bronze,
    }
