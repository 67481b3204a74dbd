"""Questions asked of the gold tables. Gold holds one row per day or zone, so
everything here is small; ties in a ranking are ordered by the key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.columns import minutes, money_sum

REVENUE = ("trip_date", "nb_trips", "total_revenue", "avg_trip_total")
DURATION = ("trip_date", "nb_trips", "avg_trip_minutes", "median_trip_minutes", "p90_trip_minutes")
ZONE_TOP = ("pickup_community_area", "nb_trips", "total_revenue", "avg_trip_total", "avg_trip_miles")


def _top(df: DataFrame, columns: tuple[str, ...], by: str, limit: int | None) -> DataFrame:
    ordered = df.select(*columns).orderBy(F.col(by).desc_nulls_last(), F.col(columns[0]))
    return ordered if limit is None else ordered.limit(limit)


def _between(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Both bounds inclusive; the filter applies only when both are given."""
    if start is None or end is None:
        return df
    return df.filter(F.col("trip_date").between(F.lit(start), F.lit(end)))


def global_kpis(revenue: DataFrame) -> DataFrame:
    """Trips, revenue and revenue per trip; trips without a total count as trips."""
    return revenue.agg(
        F.sum("nb_trips").alias("total_trips"),
        money_sum("total_revenue").alias("total_revenue"),
        F.try_divide(money_sum("total_revenue"), F.sum("nb_trips")).alias("avg_revenue_per_trip"),
    )


def global_duration(duration: DataFrame) -> DataFrame:
    """Mean minutes of all trips: the daily means weighted by their trips."""
    return global_average_duration(duration).select("avg_trip_minutes")


def global_average_duration(duration: DataFrame) -> DataFrame:
    # Durations are whole seconds: rounding brings back the exact total of each day.
    seconds = F.round(F.col("avg_trip_minutes") * F.col("nb_trips") * 60.0).cast("bigint")
    return duration.agg(
        F.try_divide(minutes(F.sum(seconds)), F.sum("nb_trips")).alias("avg_trip_minutes"),
        F.sum("nb_trips").alias("total_trips"),
    )


def period_bounds(revenue: DataFrame) -> DataFrame:
    return revenue.agg(F.min("trip_date").alias("date_min"), F.max("trip_date").alias("date_max"))


def kpi_cards(revenue: DataFrame, duration: DataFrame) -> DataFrame:
    """The global indicators as display text, one row."""
    return global_kpis(revenue).crossJoin(global_duration(duration)).select(
        F.format_number("total_trips", 0).alias("trips"),
        F.concat(F.lit("$"), F.format_number("total_revenue", 0)).alias("revenue"),
        F.concat(F.lit("$"), F.format_number("avg_revenue_per_trip", 2)).alias("revenue_per_trip"),
        F.format_string("%.1f min", "avg_trip_minutes").alias("duration"),
    )


def revenue_by_day(revenue: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    return _between(revenue, start, end).select(*REVENUE).orderBy("trip_date")


def top_revenue_days(revenue: DataFrame, limit: int = 10) -> DataFrame:
    return _top(revenue, REVENUE, "total_revenue", limit)


def top_trip_days(revenue: DataFrame, limit: int = 10) -> DataFrame:
    return _top(revenue, REVENUE, "nb_trips", limit)


def duration_by_day(duration: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    return _between(duration, start, end).select(*DURATION).orderBy("trip_date")


def longest_average_duration_days(duration: DataFrame, limit: int = 10) -> DataFrame:
    return _top(duration, DURATION, "avg_trip_minutes", limit)


def highest_p90_duration_days(duration: DataFrame, limit: int = 10) -> DataFrame:
    return _top(duration, DURATION, "p90_trip_minutes", limit)


def zones(zone_table: DataFrame) -> DataFrame:
    return zone_table.select(
        "pickup_community_area",
        "nb_trips",
        "total_revenue",
        "avg_trip_total",
        minutes("avg_trip_seconds").alias("avg_trip_minutes"),
        "avg_trip_miles",
    )


def top_zones_by_trips(zone_table: DataFrame, limit: int = 10) -> DataFrame:
    return _top(zone_table, ZONE_TOP, "nb_trips", limit)


def top_zones_by_revenue(zone_table: DataFrame, limit: int = 10) -> DataFrame:
    return _top(zone_table, ZONE_TOP, "total_revenue", limit)


def zone_activity_vs_revenue(zone_table: DataFrame, limit: int | None = None) -> DataFrame:
    """Every zone by activity, or the ``limit`` most active ones."""
    table = zones(zone_table)
    return _top(table, tuple(table.columns), "nb_trips", limit)
