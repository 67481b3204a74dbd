"""Column contract of the trip tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

AMOUNTS = ("fare", "tips", "tolls", "extras", "trip_total")
AREAS = ("pickup_community_area", "dropoff_community_area")

# Types after typing; timestamps are wall-clock times without a zone, so that no
# result depends on the session time zone.
TYPED = {
    "trip_id": T.StringType(),
    "trip_start_timestamp": T.TimestampNTZType(),
    "trip_end_timestamp": T.TimestampNTZType(),
    "trip_seconds": T.LongType(),
    "trip_miles": T.DoubleType(),
    **{name: T.DoubleType() for name in AMOUNTS},
    **{name: T.IntegerType() for name in AREAS},
    "trip_date": T.DateType(),
}

REJECT_REASON = "reject_reason"
VALID = "valid"  # the reason of a row that breaks no rule
DUPLICATE_RANK = "_duplicate_rank"
SPEED = "trip_speed_mph"

RUN_METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("finished_at", T.TimestampNTZType(), False),
        T.StructField("bronze_rows", T.LongType()),
        T.StructField("silver_rows", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("retention_rate_pct", T.DoubleType()),
        T.StructField("rejection_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("silver_path", T.StringType()),
        T.StructField("quarantine_path", T.StringType()),
    ]
)


class ContractError(ValueError):
    """A table does not have the columns or rows a job needs."""


def require_columns(df: DataFrame, required=tuple(TYPED)) -> DataFrame:
    """Return ``df``, or raise with every missing column, sorted. Runs no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError("missing columns: " + ", ".join(missing))
    return df


def require_types(df: DataFrame, expected=TYPED) -> DataFrame:
    """Return ``df``, or raise with every column whose type differs, sorted."""
    require_columns(df, expected)
    wrong = sorted(
        f"{f.name} is {f.dataType.simpleString()}, not {expected[f.name].simpleString()}"
        for f in df.schema
        if f.name in expected and f.dataType != expected[f.name]
    )
    if wrong:
        raise ContractError("wrong column types: " + "; ".join(wrong))
    return df
