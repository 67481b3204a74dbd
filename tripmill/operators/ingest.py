"""Typing of raw rows and the choice of rows that are new to a table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import columns as C
from tripmill.schema import AMOUNTS, AREAS, TYPED, require_columns


def with_trip_date(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_date", C.day_of("trip_start_timestamp"))


def typed(df: DataFrame) -> DataFrame:
    """Apply the column types; malformed values become NULL, other columns pass through.

    Columns that have their type already are left alone, which keeps the generated code
    small; amounts are always cleared of values that are no amounts.
    """
    present = {field.name: field.dataType for field in require_columns(df).schema}
    conversions = {
        "trip_id": F.col("trip_id").cast("string"),
        "trip_start_timestamp": C.wall_clock("trip_start_timestamp"),
        "trip_end_timestamp": C.wall_clock("trip_end_timestamp"),
        "trip_seconds": C.whole_number("trip_seconds"),
        "trip_miles": C.decimal_number("trip_miles"),
        **{name: C.whole_number(name, "int") for name in AREAS},
        "trip_date": F.col("trip_date").try_cast("date"),
    }
    needed = {name: column for name, column in conversions.items() if present[name] != TYPED[name]}
    return df.withColumns({**needed, **{name: C.amount(name) for name in AMOUNTS}})


def high_water_mark(existing: DataFrame, at: str = "trip_start_timestamp") -> datetime | None:
    """Latest timestamp already stored, None for an empty table."""
    return existing.agg(F.max(C.wall_clock(at))).first()[0]


def _first_day(day: date, partition: str) -> Column:
    """The partition that holds ``day``."""
    grain = {"trip_month": "month", "trip_year": "year"}.get(partition)
    return F.lit(day) if grain is None else F.trunc(F.lit(day), grain)


def _moment(value: datetime) -> Column:
    # as text: a datetime literal would pass through the zones of the process and the session
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def in_period(at: str, start: date | None, end: date) -> Column:
    """From the first moment of the day ``start`` to the last of the day ``end``."""
    midnight = datetime.min.time()
    inside = C.wall_clock(at) < _moment(datetime.combine(end + timedelta(days=1), midnight))
    if start is not None:
        inside &= C.wall_clock(at) >= _moment(datetime.combine(start, midnight))
    return inside


def new_rows(
    existing: DataFrame,
    incoming: DataFrame,
    end: date,
    start: date | None = None,
    lookback: timedelta = timedelta(0),
    batch_rows: int | None = None,
    total_rows: int | None = None,
    at: str = "trip_start_timestamp",
    key: str = "trip_id",
    known_mark: tuple[datetime | None] | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Rows of ``incoming`` to append to ``existing``, up to the end of the day ``end``.

    Rows later than the stored high-water mark are new. Rows at the mark (or within
    ``lookback`` before it) are compared with the stored ones as multisets, so a group
    of equal timestamps that an earlier batch cut in two is completed, neither losing
    nor doubling a row. Rows with a malformed start have no place in time: they are taken
    as well, less those stored already, so that they reach the quarantine. Older rows are
    not looked at. ``batch_rows`` takes the earliest rows only, ``total_rows`` stops a table
    from growing further; ``not_taken`` counts what is left out. An empty result means no
    progress.

    ``known_mark`` (a tuple of one) spares the search for the mark. ``partition`` names the
    column by which ``existing`` is stored, a day or the first day of a month or year that
    follows from ``at``: then only its partitions that reach the mark, and the one of malformed
    starts, are read.
    """
    moment = C.wall_clock(at)
    if partition is None and "trip_date" in existing.columns:
        partition = "trip_date"
    nowhere = existing.filter(moment.isNull())
    if partition is not None:
        nowhere = nowhere.filter(F.col(partition).isNull())
    malformed = incoming.filter(moment.isNull())
    malformed = malformed.exceptAll(nowhere.select(incoming.columns))
    incoming = incoming.filter(in_period(at, start, end))
    mark = high_water_mark(existing, at) if known_mark is None else known_mark[0]
    if mark is None:
        fresh = incoming
    else:
        upper, lower = _moment(mark), _moment(mark - lookback)
        stored = existing.filter(moment >= lower)
        if partition is not None:  # spares the older folders
            stored = stored.filter(F.col(partition) >= _first_day((mark - lookback).date(), partition))
        at_boundary = incoming.filter(moment.between(lower, upper))
        fresh = incoming.filter(moment > upper).unionByName(at_boundary.exceptAll(stored.select(incoming.columns)))
    fresh = fresh.unionByName(malformed)
    room = batch_rows
    if total_rows is not None:
        left = max(0, total_rows - existing.count())
        room = left if room is None else min(room, left)
    return fresh if room is None else _earliest(fresh, room, at, key)


def not_taken(
    existing: DataFrame, incoming: DataFrame, end: date, start: date | None = None, at: str = "trip_start_timestamp"
) -> DataFrame:
    """One row: how many incoming rows lie outside the period, how many are older than the
    stored mark (taken only within a lookback, or stored before), and how many are not
    older and so new, at the mark or malformed."""
    moment, mark = C.wall_clock(at), high_water_mark(existing, at)
    outside = F.coalesce(~in_period(at, start, end), F.lit(False))
    older = F.lit(False) if mark is None else F.coalesce(moment < _moment(mark), F.lit(False))
    return incoming.agg(
        F.count_if(outside).alias("outside_period"),
        F.count_if(~outside & older).alias("older_than_mark"),
        F.count_if(~outside & ~older).alias("candidates"),
    )


def _earliest(rows: DataFrame, n: int, at: str, key: str) -> DataFrame:
    """The ``n`` earliest rows, ordered by time, then key; malformed times come first.

    Sorting all rows for a limit would send up to ``n`` rows of every task to one task.
    Here the moment at which ``n`` is reached is found by counts per day, then per minute
    of that day and so on; all earlier rows pass through, and only those of that one
    moment are ordered.
    """
    if n == 0:
        return rows.limit(0)
    moment = C.wall_clock(at)
    nowhere = rows.filter(moment.isNull())
    placed, left = rows.filter(moment.isNotNull()), n - nowhere.count()
    if left <= 0:
        return nowhere.orderBy(key, C.row_hash(rows.schema)).limit(n)
    within = placed
    for step in (moment.cast("date"), F.hour(moment) * 60 + F.minute(moment), F.second(moment), moment):
        for value, count in sorted(tuple(r) for r in within.groupBy(step.alias("step")).count().collect()):
            if count >= left:
                break
            left -= count
        else:
            return rows
        cut = _moment(value) if isinstance(value, datetime) else F.lit(value)
        within = within.filter(step == cut)
    at_cut = within.orderBy(key, C.row_hash(rows.schema)).limit(left)
    return nowhere.unionByName(placed.filter(moment < cut)).unionByName(at_cut)


def appended(existing: DataFrame, incoming: DataFrame, end: date, **options) -> DataFrame:
    """``existing`` grown by its ``new_rows``."""
    return existing.unionByName(new_rows(existing, incoming, end, **options))
