"""Aggregates of silver trips by day and by pickup zone.

Every aggregate combines inside the map tasks first, so the shuffle carries one row
per task and group however many trips a day or zone holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.columns import minutes, money_avg, money_of, money_parts, money_sum
from tripmill.operators.ordered import percentile_columns


def revenue_by(silver: DataFrame, key: str = "trip_date") -> DataFrame:
    return silver.groupBy(key).agg(
        F.count("*").alias("nb_trips"),
        money_sum("fare").alias("total_fare"),
        money_sum("tips").alias("total_tips"),
        money_sum("tolls").alias("total_tolls"),
        money_sum("extras").alias("total_extras"),
        money_sum("trip_total").alias("total_revenue"),
        money_avg("trip_total").alias("avg_trip_total"),
    )


def duration_by(silver: DataFrame, key: str = "trip_date") -> DataFrame:
    """Trip count, mean, median and 90th percentile of minutes, mean miles, per group.

    The percentiles are exact. Trips are first counted per (group, second): valid
    durations are whole seconds within the threshold bounds, so a group of any size
    shrinks to some ten thousand rows, which is also less to merge than one quantile
    sketch per map task and group.
    """
    seconds = silver.groupBy(key, "trip_seconds").agg(
        F.count("*").alias("n"), F.sum("trip_miles").alias("miles"), F.count("trip_miles").alias("n_miles")
    )
    group = Window.partitionBy(key)
    up_to_here = group.orderBy("trip_seconds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = F.col("trip_seconds").isNotNull()
    known = F.when(counted, F.col("n"))
    cumulative = seconds.withColumn("upto", F.sum(known).over(up_to_here)).withColumn("known", F.sum(known).over(group))
    picks = percentile_columns("trip_seconds", "upto", "known", {"median": 0.5, "p90": 0.9})
    return _in_minutes(
        cumulative.groupBy(key).agg(
            F.sum("n").alias("nb_trips"),
            F.try_divide(F.sum(F.col("trip_seconds") * known), F.sum(known)).alias("avg"),
            *picks,
            F.try_divide(F.sum("miles"), F.sum("n_miles")).alias("avg_trip_miles"),
        ),
        key,
    )


def duration_by_approx(silver: DataFrame, key: str = "trip_date", accuracy: int = 10_000) -> DataFrame:
    """``duration_by`` with sketched percentiles, for durations that are not bounded."""
    seconds = F.col("trip_seconds")
    picks = {"median": F.percentile_approx(seconds, 0.5, accuracy), "p90": F.percentile_approx(seconds, 0.9, accuracy)}
    return _in_minutes(
        silver.groupBy(key).agg(
            F.count("*").alias("nb_trips"),
            F.try_divide(F.sum(seconds), F.count(seconds)).alias("avg"),
            *[pick.alias(name) for name, pick in picks.items()],
            F.try_divide(F.sum("trip_miles"), F.count("trip_miles")).alias("avg_trip_miles"),
        ),
        key,
    )


def _in_minutes(seconds: DataFrame, key: str) -> DataFrame:
    """The columns of the duration table from its aggregates in seconds. Their names."""
    shown = [minutes(name).alias(f"{name}_trip_minutes") for name in ("avg", "median", "p90")]
    return seconds.select(key, "nb_trips", *shown, "avg_trip_miles")


def pickup_zones(silver: DataFrame, key: str = "pickup_community_area") -> DataFrame:
    return silver.groupBy(key).agg(
        F.count("*").alias("nb_trips"),
        money_sum("trip_total").alias("total_revenue"),
        money_avg("trip_total").alias("avg_trip_total"),
        F.avg("trip_seconds").alias("avg_trip_seconds"),
        F.avg("trip_miles").alias("avg_trip_miles"),
    )


def zone_parts(silver: DataFrame, by: str = "trip_date", key: str = "pickup_community_area") -> DataFrame:
    """Partial sums per ``by`` and zone. The parts of all days together make ``pickup_zones``, so
    a day that changes costs its own rows only."""
    return silver.groupBy(by, key).agg(
        F.count("*").alias("nb_trips"),
        *[part.alias(name) for name, part in money_parts("trip_total").items()],
        *[F.count(name).alias(f"n_{name}") for name in ("trip_total", "trip_seconds", "trip_miles")],
        F.sum("trip_seconds").alias("sum_trip_seconds"),
        F.sum("trip_miles").alias("sum_trip_miles"),
    )


def zones_of(parts: DataFrame, key: str = "pickup_community_area") -> DataFrame:
    """``pickup_zones`` from partial sums."""
    total = money_of([F.sum(name) for name in money_parts("trip_total")])
    return parts.groupBy(key).agg(
        F.sum("nb_trips").alias("nb_trips"),
        total.alias("total_revenue"),
        F.try_divide(total, F.sum("n_trip_total")).alias("avg_trip_total"),
        F.try_divide(F.sum("sum_trip_seconds"), F.sum("n_trip_seconds")).alias("avg_trip_seconds"),
        F.try_divide(F.sum("sum_trip_miles"), F.sum("n_trip_miles")).alias("avg_trip_miles"),
    )
