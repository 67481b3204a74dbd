"""Ordered data-quality rules: every row gets one reason, the first that applies."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.columns import speed_mph
from tripmill.operators import dedup
from tripmill.operators.dedup import CopyPolicy
from tripmill.operators.ingest import typed
from tripmill.schema import AMOUNTS, AREAS, DUPLICATE_RANK, REJECT_REASON, SPEED, VALID


@dataclass(frozen=True)
class Thresholds:
    """Bounds of a valid trip, all inclusive."""

    # The defaults.
    min_seconds: int = 1
    max_seconds: int = 6 * 3600
    min_miles: float = 0.0
    max_miles: float = 100.0
    max_speed_mph: float = 100.0


Rule = tuple[str, Column]


def _unless(condition: Column) -> Column:
    """True where ``condition`` is false or unknown: a missing value breaks the rule."""
    return ~F.coalesce(condition, F.lit(False))


NO_ID = "null_trip_id"
DUPLICATE = "duplicate_trip_id"


def id_rules() -> list[Rule]:
    return [(NO_ID, F.col("trip_id").isNull()), (DUPLICATE, F.col(DUPLICATE_RANK) > 1)]


def value_rules(limits: Thresholds = Thresholds()) -> list[Rule]:
    seconds, miles, speed = F.col("trip_seconds"), F.col("trip_miles"), F.col(SPEED)
    in_order = F.col("trip_end_timestamp") >= F.col("trip_start_timestamp")
    return [
        ("invalid_timestamp", _unless(in_order)),
        ("invalid_duration", _unless(seconds.between(limits.min_seconds, limits.max_seconds))),
        ("invalid_distance", _unless(miles.between(limits.min_miles, limits.max_miles))),
        ("invalid_speed", _unless(speed <= F.lit(limits.max_speed_mph))),
        ("negative_amount", _negative_amount()),
        ("missing_geography", F.col(AREAS[0]).isNull() | F.col(AREAS[1]).isNull()),
    ]


def _negative_amount() -> Column:
    """Whether the smallest of the known amounts is below zero."""
    return F.least(*AMOUNTS) < 0


def reason(rules: list[Rule]) -> Column:
    """Name of the first rule that applies, else ``valid``."""
    first, *others = rules
    chain = reduce(lambda case, rule: case.when(rule[1], rule[0]), others, F.when(first[1], first[0]))
    return chain.otherwise(VALID)


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.withColumn(REJECT_REASON, reason(rules))


def tagged(
    bronze: DataFrame,
    limits: Thresholds = Thresholds(),
    tie_break: tuple[str, ...] | None = None,
    dedup_after_validation: bool = False,
    policy: CopyPolicy = CopyPolicy(),
) -> DataFrame:
    """Type, rank and tag every row of ``bronze``.

    By default copies are ranked before validation: an invalid newest copy hides its
    older valid copies. With ``dedup_after_validation`` only rows that break no other
    rule compete, so the newest valid copy survives.
    """
    rows = typed(bronze)
    if not dedup_after_validation:
        rows = dedup.ranked(rows, tie_break=tie_break, policy=policy).withColumn(SPEED, speed_mph())
        return tag(rows, id_rules() + value_rules(limits))
    no_id = id_rules()[:1]
    checked = tag(rows.withColumn(SPEED, speed_mph()), no_id + value_rules(limits))
    sound, unsound = (checked.filter(c) for c in (_is_valid(), ~_is_valid()))
    competing = dedup.ranked(sound.drop(REJECT_REASON), tie_break=tie_break, policy=policy)
    unranked = unsound.withColumn(DUPLICATE_RANK, F.lit(None).cast("bigint"))
    return tag(competing, id_rules()).unionByName(unranked)


def _is_valid() -> Column:
    return F.col(REJECT_REASON) == VALID


def silver_of(tagged_rows: DataFrame) -> DataFrame:
    return tagged_rows.filter(_is_valid()).drop(REJECT_REASON, DUPLICATE_RANK)


def quarantine_of(tagged_rows: DataFrame) -> DataFrame:
    return tagged_rows.filter(~_is_valid())


def split(tagged_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine)"""
    return silver_of(tagged_rows), quarantine_of(tagged_rows)


def silver(
    bronze: DataFrame,
    limits: Thresholds = Thresholds(),
    tie_break: tuple[str, ...] | None = None,
) -> DataFrame:
    """The valid rows alone, equal to ``silver_of(tagged(...))``.

    Without the rejected rows nothing but the newest copy of an id is needed, which
    shrinks the shuffle and needs no special care for hot ids.
    """
    newest = dedup.latest(typed(bronze), tie_break=tie_break).withColumn(SPEED, speed_mph())
    return silver_of(tag(newest, value_rules(limits)))


def reason_counts(tagged_rows: DataFrame, *by: str) -> DataFrame:
    return tagged_rows.groupBy(*by, REJECT_REASON).agg(F.count("*").alias("n_rows"))


def retention(counts: DataFrame) -> DataFrame:
    """Totals and the share of valid rows from ``reason_counts``, one row."""
    total = F.coalesce(F.sum("n_rows"), F.lit(0))
    valid = F.coalesce(F.sum(F.when(_is_valid(), F.col("n_rows"))), F.lit(0))
    return counts.agg(total.alias("bronze_rows"), valid.alias("silver_rows")).select(
        "bronze_rows",
        "silver_rows",
        (F.col("bronze_rows") - F.col("silver_rows")).alias("rejected_rows"),
        retention_pct(F.col("silver_rows"), F.col("bronze_rows")).alias("retention_rate_pct"),
    )


def retention_pct(valid: Column, total: Column) -> Column:
    return F.try_divide(valid, total) * F.lit(100.0)


def reconciliation(
    bronze: DataFrame, silver_rows: DataFrame, quarantine: DataFrame, by: str = "trip_date"
) -> DataFrame:
    """Row counts of the three tables per day; ``difference`` is 0 where they agree.

    Each table is counted on its own and only the counts meet, so days that lack rows
    in one of the tables (and the null day) are covered too.
    """
    names = ("bronze_rows", "silver_rows", "quarantine_rows")
    counts = reduce(
        DataFrame.unionByName,
        [
            df.groupBy(by).agg(F.count("*").alias("n")).withColumn("side", F.lit(name))
            for name, df in zip(names, (bronze, silver_rows, quarantine))
        ],
    )
    return _sides(counts, by)


def reconciliation_of(bronze: DataFrame, tagged_rows: DataFrame, by: str = "trip_date") -> DataFrame:
    """``reconciliation`` where silver and quarantine are still one tagged frame, which is then
    evaluated once for both."""
    outcome = F.when(_is_valid(), "silver_rows").otherwise("quarantine_rows")
    sides = [(bronze, F.lit("bronze_rows")), (tagged_rows, outcome)]
    counts = reduce(DataFrame.unionByName, [df.groupBy(by, s.alias("side")).agg(F.count("*").alias("n")) for df, s in sides])
    return _sides(counts, by)


def _sides(counts: DataFrame, by: str) -> DataFrame:
    names = ("bronze_rows", "silver_rows", "quarantine_rows")
    per_side = [F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).alias(s) for s in names]
    difference = F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")
    return counts.groupBy(by).agg(*per_side).withColumn("difference", difference)


def checks(
    tagged_rows: DataFrame, min_retention_pct: float = 50.0, max_retention_pct: float = 100.0
) -> DataFrame:
    """Four checks of a run as rows (check, passed, observed), from one aggregate."""
    valid = _is_valid()
    valid_id = F.when(valid, F.col("trip_id"))
    facts = tagged_rows.agg(
        F.count("*").alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_distinct(valid_id).alias("ids"),
        F.count_if(valid & _negative_amount()).alias("negative"),
    ).withColumn("kept", F.coalesce(retention_pct(F.col("valid"), F.col("total")), F.lit(0.0)))
    repeated = F.col("valid") - F.col("ids")
    rows = [
        ("silver_not_empty", F.col("valid") > 0, F.col("valid")),
        ("retention_in_range", F.col("kept").between(min_retention_pct, max_retention_pct), F.col("kept")),
        ("no_duplicate_trip_id", repeated == 0, repeated),
        ("no_negative_amount", F.col("negative") == 0, F.col("negative")),
    ]
    structs = [
        F.struct(F.lit(name).alias("check"), passed.alias("passed"), seen.cast("double").alias("observed"))
        for name, passed, seen in rows
    ]
    return facts.select(F.inline(F.array(*structs)))


def replay(quarantine: DataFrame, limits: Thresholds) -> DataFrame:
    """Tag quarantined rows again under other bounds.

    The recorded rank is kept: it was taken over all copies, and ranking the rejected
    ones among themselves would let a copy in whose newer twin is in silver already.
    """
    rows = quarantine.drop(REJECT_REASON, SPEED).withColumn(SPEED, speed_mph())
    return tag(rows, id_rules() + value_rules(limits))
