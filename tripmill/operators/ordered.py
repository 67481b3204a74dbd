"""Running totals and percentiles that never need one key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.sources.staging import staged


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    weight: Column,
    name: str,
) -> DataFrame:
    """Add ``name``: the total of ``weight`` up to and including each row, per key.

    A plain window would sort a whole key in one task. Here a range partitioning by
    (keys, order) cuts a large key into slices of even size; each slice is totalled
    on its own and shifted by the total of the slices before it. ``order`` must be
    total within a key. ``keys`` must not be null.

    The sliced rows are written once: both the totals and the rows must see the very
    same slices, and the bounds of a range partitioning are sampled anew per run.
    """
    rows = staged(
        df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    up_to_here = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per key and slice it touches: at most (keys + slices) rows.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        rows.groupBy(*keys, "_slice")
        .agg(F.sum(weight).alias("_in_slice"))
        .select(*keys, "_slice", F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        rows.join(shifts, [*keys, "_slice"])
        .withColumn(name, F.col("_before") + F.sum(weight).over(up_to_here))
        .drop("_slice", "_before")
    )


def histogram(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per key and distinct non-null value; equal values collapse before the shuffle."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def percentile_columns(value: str, cumulative: str, total: str, probabilities: dict[str, float]) -> list[Column]:
    """Smallest value whose cumulative share reaches each probability."""
    share = F.col(cumulative) / F.col(total)
    return [F.min(F.when(share >= F.lit(p), F.col(value))).alias(name) for name, p in probabilities.items()]


def measure_percentiles(
    df: DataFrame, measures: dict[str, Column], probabilities: dict[str, float]
) -> DataFrame:
    """Exact minimum, percentiles and maximum of whole columns, one row per measure.

    One scan serves all measures. Each percentile is a value of the data (the
    discrete definition). NaN counts as the largest value.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), c.cast("double").alias("value")) for m, c in measures.items()])
    values = df.select(F.inline(pairs))
    counted = running_total(
        histogram(values, ["measure"], "value"), ["measure"], [F.col("value").asc()], F.col("n"), "upto"
    )
    totals = counted.groupBy("measure").agg(
        F.max("upto").alias("total"), F.min("value").alias("minimum"), F.max("value").alias("maximum")
    )
    return (
        counted.join(totals, "measure")
        .groupBy("measure")
        .agg(
            F.first("minimum").alias("minimum"),
            *percentile_columns("value", "upto", "total", probabilities),
            F.first("maximum").alias("maximum"),
        )
    )
