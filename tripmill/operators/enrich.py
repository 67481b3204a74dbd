"""Zone names, area geometry, calendar events and display forms.

The dimensions are joined without a broadcast hint: Catalyst broadcasts them where
their measured size allows and shuffles them where it does not.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.columns import area_key, title_case

# Display labels of the columns.
LABELS = {
    "trip_date": "Date",
    "nb_trips": "Nombre de trajets",
    "total_revenue": "Revenu total ($)",
    "avg_trip_total": "Revenu moyen par trajet ($)",
    "avg_trip_minutes": "Durée moyenne (min)",
    "median_trip_minutes": "Durée médiane (min)",
    "p90_trip_minutes": "Durée P90 (min)",
    "avg_trip_miles": "Distance moyenne (miles)",
    "avg_trip_seconds": "Durée moyenne (s)",
    "pickup_community_area": "Zone (community area)",
    "value": "Valeur",
    "zone_name": "Zone (nom)",
    "variable": "Métrique",
}

DURATION_SERIES = ("avg_trip_minutes", "median_trip_minutes", "p90_trip_minutes")
EVENTS_SCHEMA = "name string, start date, end date"


def _one_row_per_area(areas: DataFrame) -> DataFrame:
    others = [c for c in areas.columns if c != "area_num_1"]
    kept = F.max(F.struct(*others)).alias("area")
    return areas.groupBy("area_num_1").agg(kept).select("area_num_1", "area.*")


def with_zone_names(zones: DataFrame, areas: DataFrame, key: str = "pickup_community_area") -> DataFrame:
    """Add ``zone_name`` right after the zone key; NULL where the area is unknown.

    ``areas`` has ``area_num_1`` (text) and ``community``; it may be empty.
    """
    names = _one_row_per_area(areas.select("area_num_1", "community")).select(
        F.col("area_num_1").alias("_area"), title_case("community").alias("zone_name")
    )
    at = zones.columns.index(key) + 1
    shown = [*zones.columns[:at], "zone_name", *zones.columns[at:]]
    return zones.join(names, area_key(key) == F.col("_area"), "left").select(*shown)


def zone_map(zones: DataFrame, areas: DataFrame, key: str = "pickup_community_area") -> DataFrame:
    """Zone measures next to the outline of their area; zones without one are left out.

    The key comes back as text, the form in which the outlines are keyed.
    """
    outlines = _one_row_per_area(areas.select("area_num_1", "geometry"))
    keyed = zones.withColumn(key, area_key(key))
    return keyed.join(outlines, F.col(key) == F.col("area_num_1")).drop("area_num_1")


def event_bands(events: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Events that overlap the period, with the end at which a chart band closes.

    A one-day event closes a day later, so that its band has a width.
    """
    if start is not None:
        events = events.filter(F.col("end") >= F.lit(start))
    if end is not None:
        events = events.filter(F.col("start") <= F.lit(end))
    one_day = F.col("start") == F.col("end")
    band_end = F.when(one_day, F.date_add("end", 1)).otherwise(F.col("end"))
    return events.select("name", "start", band_end.alias("band_end"))


def with_event_names(
    days: DataFrame, events: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Add ``event_name`` to a daily table: one row per day and event, NULL without any.

    Each event is spread over its days (clipped to the period, if one is given), so the
    overlap becomes an equality join on the day.
    """
    first = F.col("start") if start is None else F.greatest(F.col("start"), F.lit(start))
    last = F.col("end") if end is None else F.least(F.col("end"), F.lit(end))
    spread = events.filter(first <= last).select(
        F.explode(F.sequence(first, last)).alias("_day"), F.col("name").alias("event_name")
    )
    return days.join(spread, F.col("trip_date") == F.col("_day"), "left").drop("_day")


def duration_long(duration: DataFrame) -> DataFrame:
    """One row per day and duration series, for a chart with several lines."""
    return duration.unpivot(["trip_date"], list(DURATION_SERIES), "variable", "value")


def pretty(df: DataFrame, labels: dict[str, str] = LABELS) -> DataFrame:
    """Readable headers and dates as text, for display."""
    if "trip_date" in df.columns:
        df = df.withColumn("trip_date", F.date_format("trip_date", "yyyy-MM-dd"))
    return df.withColumnsRenamed(labels)
