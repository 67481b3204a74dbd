"""Hand-written trips: a valid base row and changes to it."""

from __future__ import annotations

from datetime import datetime

from tripmill.operators import ingest

BASE = {
    "trip_id": "T1",
    "trip_start_timestamp": "2023-10-08T10:00:00.000",
    "trip_end_timestamp": "2023-10-08T10:20:00.000",
    "trip_seconds": "1200",
    "trip_miles": "5.0",
    "fare": "15",
    "tips": "3",
    "tolls": "0",
    "extras": "1",
    "trip_total": "19",
    "pickup_community_area": "8",
    "dropoff_community_area": "32",
}
RAW_SCHEMA = ", ".join(f"{name} string" for name in BASE) + ", note string"


def raw(spark, *changes: dict):
    """Raw text rows: the base row with each set of changes; ``note`` passes through."""
    rows = [{**BASE, "note": str(i), **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in [*BASE, "note"]) for r in rows], RAW_SCHEMA)


def bronze(spark, *changes: dict):
    return ingest.with_trip_date(raw(spark, *changes))


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def by_note(df, column: str) -> dict:
    return {r["note"]: r[column] for r in df.select("note", column).collect()}


def rows(df) -> list[tuple]:
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
