"""Typing, measures and text formats as native column expressions.

Everything stays valid under ANSI mode: malformed input becomes NULL through
``try_cast`` and ``try_divide`` and never stops a job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

def wall_clock(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz")


def day_of(name: str) -> Column:
    """Calendar day of a timestamp column or text, NULL when malformed."""
    return wall_clock(name).cast("date")


def whole_number(name: str, to: str = "bigint") -> Column:
    """Whole number; text with a fraction ('12.7') is truncated to 12."""
    value = F.col(name)
    return F.coalesce(value.try_cast(to), value.try_cast("double").try_cast(to))


def decimal_number(name: str) -> Column:
    return F.col(name).try_cast("double")


def amount(name: str) -> Column:
    """Money as double. NaN and plus infinity are no amounts: NULL like any malformed text, so
    the row stays. Minus infinity stays, as the rules reject it like any amount below zero."""
    value = decimal_number(name)
    return F.when(value < F.lit(float("inf")), value)  # NaN is the largest value


def speed_mph(miles: str = "trip_miles", seconds: str = "trip_seconds") -> Column:
    """Mean speed; NULL for zero seconds, negative for negative seconds."""
    return F.try_divide(F.col(miles), F.col(seconds) / F.lit(3600.0))


def speed_mph_if_moving(miles: str = "trip_miles", seconds: str = "trip_seconds") -> Column:
    """Mean speed, NULL unless the trip lasted more than zero seconds."""
    return F.when(F.col(seconds) > 0, speed_mph(miles, seconds))


def minutes(seconds: Column | str) -> Column:
    return (F.col(seconds) if isinstance(seconds, str) else seconds) / F.lit(60.0)


#: Amounts of this size and more are added as doubles: they have no cents to lose.
LARGE_AMOUNT = 1e13


def money_parts(name: str) -> dict[str, Column]:
    """Partial sums of a money column, by name: bigints that are the same in whatever order
    they are merged, and the sum of large amounts as double. Sums of parts are parts again.

    Every amount is split into millions, whole units and millionths (decimal buffers measured
    13 times slower). Decimals beyond the sixth are rounded per amount. The bigints hold for
    9 * 10^11 amounts of any size below ``LARGE_AMOUNT``. Infinities and NaN are no amounts.
    """
    value = F.col(name)
    large = F.abs(value) >= F.lit(LARGE_AMOUNT)
    small = F.when(large, F.lit(0.0)).otherwise(value)
    low = F.pmod(small, F.lit(1e6))
    units = F.floor(low)
    finite = large & (F.abs(value) < F.lit(float("inf")))
    return {
        f"{name}_millions": F.sum(F.round((small - low) / 1e6).cast("bigint")),
        f"{name}_units": F.sum(units),
        f"{name}_millionths": F.sum(F.floor((low - units) * 1e6 + 0.5)),
        f"{name}_large": F.sum(F.when(finite, value)),
    }


def money_of(parts: list[Column]) -> Column:
    """Amount that partial sums (millions, units, millionths, large) stand for, to six decimals."""
    scales = (Decimal(1_000_000), Decimal(1), Decimal("0.000001"))
    sums = [part.cast("decimal(20,0)") * F.lit(scale) for part, scale in zip(parts, scales)]
    return (sums[0] + sums[1] + sums[2]).cast("double") + F.coalesce(parts[3], F.lit(0.0))


def money_sum(name: str) -> Column:
    """Sum of a money column to six decimals, the same in whatever order partial sums are
    merged; see ``money_parts`` for amounts of 10^13 and more."""
    return money_of(list(money_parts(name).values()))


def money_avg(name: str) -> Column:
    return F.try_divide(money_sum(name), F.count(name))


def title_case(name: str) -> Column:
    """Capital after every space and apostrophe: "O'HARE" -> "O'Hare"."""
    parts = F.transform(F.split(F.lower(F.col(name)), "'"), F.initcap)
    return F.array_join(parts, "'")


def row_hash(schema: T.StructType) -> Column:
    """Hash of every column that can be hashed, whatever the column order."""
    return F.xxhash64(*sorted(f.name for f in schema if not _holds_map(f.dataType)))


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    return isinstance(dtype, (T.MapType, T.VariantType))


def area_key(name: str) -> Column:
    """Area number as text without a fraction: 8, 8.0 and '8' all give '8'."""
    return whole_number(name, "int").cast("string")
