"""Profile of raw or typed trips: identity, distributions and extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.columns import speed_mph_if_moving
from tripmill.operators.ordered import measure_percentiles
from tripmill.schema import SPEED

# Percentile points, accuracy and columns of the profile.
PROBABILITIES = (0.50, 0.90, 0.95, 0.99, 0.995, 0.999)
ACCURACY = 10_000

EXTREME_COLUMNS = ("trip_id", "trip_seconds", "trip_miles", SPEED, "trip_total")


def point_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def _identity(distinct: Column) -> list[Column]:
    return [
        F.count("*").alias("rows"),
        distinct.alias("distinct_trip_id"),
        F.count_if(F.col("trip_id").isNull()).alias("null_trip_id"),
    ]


def identity(df: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct("trip_id") if approximate else F.count_distinct("trip_id")
    return df.agg(*_identity(distinct))


def distribution(df: DataFrame, measure: Column, unit: str, to: str = "double") -> DataFrame:
    """Exact minimum, percentiles and maximum of one measure, one row."""
    points = {point_name(p): p for p in PROBABILITIES}
    found = measure_percentiles(df, {unit: measure}, points)
    names = {"minimum": f"min_{unit}", **{n: f"{n}_{unit}" for n in points}, "maximum": f"max_{unit}"}
    return found.select(*[F.col(c).cast(to).alias(name) for c, name in names.items()])


def duration(df: DataFrame) -> DataFrame:
    return distribution(df, F.col("trip_seconds"), "seconds", to="bigint")


def distance(df: DataFrame) -> DataFrame:
    return distribution(df, F.col("trip_miles"), "miles")


def speed(df: DataFrame) -> DataFrame:
    return distribution(df, speed_mph_if_moving(), "speed")


def distributions(df: DataFrame) -> DataFrame:
    """The three distributions exactly, from one scan, one row per measure."""
    measures = {"seconds": F.col("trip_seconds"), "miles": F.col("trip_miles"), "speed": speed_mph_if_moving()}
    return measure_percentiles(df, measures, {point_name(p): p for p in PROBABILITIES})


def summary(df: DataFrame) -> DataFrame:
    """Identity and sketched distributions in a single pass, one row.

    Percentiles come as arrays in the order of ``PROBABILITIES``; the distinct count
    is a sketch too, which keeps the whole profile free of a shuffle by id.
    """
    measures = {"seconds": F.col("trip_seconds"), "miles": F.col("trip_miles"), "speed": speed_mph_if_moving()}
    points = F.array(*[F.lit(p) for p in PROBABILITIES])
    spread = [
        column
        for unit, value in measures.items()
        for column in (
            F.min(value).alias(f"min_{unit}"),
            F.percentile_approx(value, points, ACCURACY).alias(f"percentiles_{unit}"),
            F.max(value).alias(f"max_{unit}"),
        )
    ]
    return df.agg(*_identity(F.approx_count_distinct("trip_id")), *spread)


def extremes(df: DataFrame, by: str, limit: int = 20, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The ``limit`` trips with the largest ``by``, nulls last.

    Equal values are ordered by the other shown columns, then by ``tie_break``.
    """
    others = [c for c in (*EXTREME_COLUMNS, *tie_break) if c != by]
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in others]]
    shown = df.withColumn(SPEED, speed_mph_if_moving())
    return shown.orderBy(*order).limit(limit).select(*EXTREME_COLUMNS)


def extreme_distances(df: DataFrame, limit: int = 20) -> DataFrame:
    return extremes(df, "trip_miles", limit)


def extreme_speeds(df: DataFrame, limit: int = 20) -> DataFrame:
    return extremes(df, SPEED, limit)
