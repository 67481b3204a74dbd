"""Mergeable sketches of trips per day, for profiles of any period without its trips.

A day keeps its rows, its trips without an id, a HyperLogLog sketch of its ids, and for each
measure its count, bounds and a KLL sketch of its values. Sketches of days merge into that of
a period. Sketches have a bounded size, some ten kilobytes a day, whatever the day holds.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.columns import speed_mph_if_moving
from tripmill.operators.profile import PROBABILITIES, point_name

#: Size of a KLL sketch, and the error of a percentile's rank that it keeps to (99 % confidence).
KLL_SIZE, RANK_ERROR = 1000, 0.005
#: Binary logarithm of the registers of a HyperLogLog sketch, and three standard errors of its count.
HLL_SIZE, COUNT_ERROR = 14, 0.025


def measures() -> dict[str, Column]:
    return {"seconds": F.col("trip_seconds").cast("double"), "miles": F.col("trip_miles"), "speed": speed_mph_if_moving()}


def by_day(trips: DataFrame, by: str = "trip_date") -> DataFrame:
    """A row of sketches per ``by``; each map task sends one sketch per day and measure."""
    values = measures()
    columns = [c for name in values for c in _of_measure(name)]
    return trips.withColumns({f"_{name}": value for name, value in values.items()}).groupBy(by).agg(
        F.count("*").alias("nb_trips"),
        F.count_if(F.col("trip_id").isNull()).alias("nb_without_id"),
        F.hll_sketch_agg("trip_id", HLL_SIZE).alias("ids"),
        *columns,
    )


def _of_measure(name: str) -> list[Column]:
    value = F.col(f"_{name}")
    return [
        F.count(value).alias(f"n_{name}"),
        F.min(value).alias(f"min_{name}"),
        F.max(value).alias(f"max_{name}"),
        F.kll_sketch_agg_double(value, KLL_SIZE).alias(f"kll_{name}"),
    ]


def merged(sketches: DataFrame, start: date | None = None, end: date | None = None, by: str = "trip_date") -> DataFrame:
    """One row of sketches for the days from ``start`` to ``end``, inclusive; without bounds for
    all, rows without a day among them."""
    if start is not None:
        sketches = sketches.filter(F.col(by) >= F.lit(start))
    if end is not None:
        sketches = sketches.filter(F.col(by) <= F.lit(end))
    merges = [
        c
        for name in measures()
        for c in (
            F.sum(f"n_{name}").alias(f"n_{name}"),
            F.min(f"min_{name}").alias(f"min_{name}"),
            F.max(f"max_{name}").alias(f"max_{name}"),
            # a day without any value has a sketch that holds nothing
            F.kll_merge_agg_double(F.when(F.col(f"n_{name}") > 0, F.col(f"kll_{name}"))).alias(f"kll_{name}"),
        )
    ]
    return sketches.agg(
        F.sum("nb_trips").alias("nb_trips"), F.sum("nb_without_id").alias("nb_without_id"), F.hll_union_agg("ids").alias("ids"), *merges
    )


def distinct_ids(period: DataFrame) -> DataFrame:
    """Rows, distinct ids (estimated within ``COUNT_ERROR``) and rows without an id of a period."""
    return period.select(
        F.col("nb_trips").alias("rows"),
        F.coalesce(F.hll_sketch_estimate("ids"), F.lit(0)).cast("long").alias("distinct_trip_id"),
        F.col("nb_without_id").alias("null_trip_id"),
    )


def percentiles(period: DataFrame, probabilities: tuple[float, ...] = PROBABILITIES) -> DataFrame:
    """A row per measure: count, bounds, and percentiles whose rank is off by ``RANK_ERROR`` at
    most. A measure without values has a count of 0 and NULLs."""
    points = F.array(*[F.lit(p) for p in probabilities])
    rows = []
    for name in measures():
        found = F.when(F.col(f"n_{name}") > 0, F.kll_sketch_get_quantile_double(f"kll_{name}", points))
        rows.append(
            F.struct(
                F.lit(name).alias("measure"), F.coalesce(f"n_{name}", F.lit(0)).alias("n"), F.col(f"min_{name}").alias("minimum"),
                *[F.get(found, i).alias(point_name(p)) for i, p in enumerate(probabilities)], F.col(f"max_{name}").alias("maximum"),
            )
        )
    return period.select(F.inline(F.array(*rows)))


def rank_errors(trips: DataFrame, found: DataFrame, probabilities: tuple[float, ...] = PROBABILITIES) -> DataFrame:
    """How far the ranks of sketched percentiles are from their probabilities: a row (measure,
    n, minimum, maximum, rank_error) with the largest error, from one pass over the trips."""
    asked = found.select(
        "measure", "minimum", "maximum",
        F.inline(F.array(*[F.struct(F.lit(p).alias("p"), F.col(point_name(p)).alias("value")) for p in probabilities])),
    )
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), c.alias("v")) for m, c in measures().items()])
    values = trips.select(F.inline(pairs)).filter(F.col("v").isNotNull()).groupBy("measure", "v").agg(F.count("*").alias("n"))
    # a few percentiles per measure: the small side of the join
    ranks = values.join(asked, "measure").groupBy("measure", "minimum", "maximum", "p", "value").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("v") < F.col("value"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("value"), F.col("n")).otherwise(0)).alias("upto"),
    )
    error = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - F.col("p"), F.col("p") - F.col("upto") / F.col("n"))
    return ranks.groupBy("measure", "n", "minimum", "maximum").agg(F.max(error).alias("rank_error"))
