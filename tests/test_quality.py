import pytest

from tests.helpers import bronze, by_note, rows
from tripmill.operators import quality
from tripmill.operators.quality import Thresholds
from tripmill.schema import ContractError, require_types
from tripmill.operators.ingest import typed

LONG = {"trip_seconds": "7200"}

BOUNDARIES = [
    ({"trip_id": None}, "null_trip_id"),
    ({"trip_end_timestamp": "2023-10-08 10:00:00"}, "valid"),
    ({"trip_end_timestamp": "2023-10-08 09:59:59"}, "invalid_timestamp"),
    ({"trip_end_timestamp": None}, "invalid_timestamp"),
    ({"trip_start_timestamp": None}, "invalid_timestamp"),
    ({"trip_start_timestamp": "nope"}, "invalid_timestamp"),
    ({"trip_seconds": "0"}, "invalid_duration"),
    ({"trip_seconds": "1", "trip_miles": "0.01"}, "valid"),
    ({"trip_seconds": "21600"}, "valid"),
    ({"trip_seconds": "21601"}, "invalid_duration"),
    ({"trip_seconds": None}, "invalid_duration"),
    ({"trip_seconds": "abc"}, "invalid_duration"),
    ({"trip_seconds": "1200.7"}, "valid"),
    ({**LONG, "trip_miles": "-0.1"}, "invalid_distance"),
    ({**LONG, "trip_miles": "0"}, "valid"),
    ({**LONG, "trip_miles": "100"}, "valid"),
    ({**LONG, "trip_miles": "100.1"}, "invalid_distance"),
    ({**LONG, "trip_miles": "NaN"}, "invalid_distance"),
    ({"trip_miles": None}, "invalid_distance"),
    ({"trip_miles": "50", "trip_seconds": "1800"}, "valid"),
    ({"trip_miles": "50.1", "trip_seconds": "1800"}, "invalid_speed"),
    *[({name: "-0.01"}, "negative_amount") for name in ("fare", "tips", "tolls", "extras", "trip_total")],
    *[({name: None}, "valid") for name in ("fare", "tips", "tolls", "extras", "trip_total")],
    *[({name: "0"}, "valid") for name in ("fare", "tips", "tolls", "extras", "trip_total")],
    ({"fare": "NaN"}, "valid"),
    ({"fare": "Infinity"}, "valid"),
    ({"fare": "-Infinity"}, "negative_amount"),
    ({"pickup_community_area": None}, "missing_geography"),
    ({"dropoff_community_area": None}, "missing_geography"),
    # several rules broken: the first one names the reason
    ({"trip_seconds": "0", "fare": "-1", "pickup_community_area": None}, "invalid_duration"),
    ({"trip_id": None, "trip_seconds": "0"}, "null_trip_id"),
    ({"trip_end_timestamp": None, "trip_miles": "-1"}, "invalid_timestamp"),
    ({"fare": "-1", "dropoff_community_area": None}, "negative_amount"),
]


def test_each_rule_at_its_boundary(spark):
    changes = [{"trip_id": f"T{i}", **change} for i, (change, _) in enumerate(BOUNDARIES)]
    found = by_note(quality.tagged(bronze(spark, *changes)), "reject_reason")
    assert found == {str(i): reason for i, (_, reason) in enumerate(BOUNDARIES)}


def test_malformed_text_becomes_null(spark):
    row = typed(
        bronze(spark, {"trip_start_timestamp": "nope", "trip_seconds": "12.7", "fare": "NaN", "tips": "x"})
    ).first()
    assert row["trip_start_timestamp"] is None and row["trip_date"] is None
    assert row["trip_seconds"] == 12 and row["fare"] is None and row["tips"] is None
    require_types(typed(bronze(spark, {})))


def test_zero_seconds_allowed_by_the_bounds_still_lack_a_speed(spark):
    tagged = quality.tagged(bronze(spark, {"trip_seconds": "0"}), Thresholds(min_seconds=0))
    assert tagged.first()["reject_reason"] == "invalid_speed"


def test_newest_copy_wins(spark):
    end, start = "trip_end_timestamp", "trip_start_timestamp"
    changes = [
        {"trip_id": "A"},
        {"trip_id": "A", end: "2023-10-08 10:15:00"},
        {"trip_id": "A", end: None},
        {"trip_id": "B", start: "2023-10-08 10:01:00"},
        {"trip_id": "B", "trip_total": "99"},
        {"trip_id": "C", "trip_total": "18"},
        {"trip_id": "C", "trip_total": "19"},
        {"trip_id": "C", "trip_total": None},
        {"trip_id": None},
        {"trip_id": None},
        {"trip_id": None},
    ]
    tagged = quality.tagged(bronze(spark, *changes))
    assert by_note(tagged, "_duplicate_rank") == {
        "0": 1, "1": 2, "2": 3, "3": 1, "4": 2, "5": 2, "6": 1, "7": 3, "8": None, "9": None, "10": None,
    }
    reasons = by_note(tagged, "reject_reason")
    assert [reasons[n] for n in ("8", "9", "10")] == ["null_trip_id"] * 3
    assert {n for n, r in reasons.items() if r == "duplicate_trip_id"} == {"1", "2", "4", "5", "7"}


def test_an_invalid_newest_copy_hides_the_older_one_unless_asked(spark):
    data = bronze(spark, {"trip_seconds": "0"}, {"trip_end_timestamp": "2023-10-08 10:15:00"})
    assert by_note(quality.tagged(data), "reject_reason") == {"0": "invalid_duration", "1": "duplicate_trip_id"}
    assert quality.silver(data).count() == 0
    after = quality.tagged(data, dedup_after_validation=True)
    assert by_note(after, "reject_reason") == {"0": "invalid_duration", "1": "valid"}


def test_silver_alone_equals_the_tagged_silver(spark):
    changes = [{"trip_id": f"T{i % 7}", "trip_total": str(i), **c} for i, (c, _) in enumerate(BOUNDARIES)]
    data = bronze(spark, *changes)
    assert rows(quality.silver(data)) == rows(quality.silver_of(quality.tagged(data)))


def test_missing_columns_are_listed_sorted(spark):
    incomplete = bronze(spark, {}).drop("tips", "fare")
    with pytest.raises(ContractError, match="missing columns: fare, tips$"):
        quality.tagged(incomplete)
    with pytest.raises(ContractError, match="trip_seconds is string, not bigint"):
        require_types(bronze(spark, {}))


def test_counts_retention_checks_and_reconciliation(spark):
    data = bronze(spark, {"trip_id": "A"}, {"trip_id": "B"}, {"trip_id": "C", "fare": "-1"}, {"trip_id": None})
    tagged = quality.tagged(data)
    counts = {r[0]: r[1] for r in quality.reason_counts(tagged).collect()}
    assert counts == {"valid": 2, "negative_amount": 1, "null_trip_id": 1}
    assert tuple(quality.retention(quality.reason_counts(tagged)).first()) == (4, 2, 2, 50.0)
    assert all(r["passed"] for r in quality.checks(tagged).collect())
    failed = {r["check"] for r in quality.checks(tagged, min_retention_pct=90).collect() if not r["passed"]}
    assert failed == {"retention_in_range"}
    silver, quarantine = quality.split(tagged)
    assert {r["difference"] for r in quality.reconciliation(data, silver, quarantine).collect()} == {0}
    lost = quality.reconciliation(data, silver, quarantine.limit(0)).collect()
    assert [(r["bronze_rows"], r["silver_rows"], r["difference"]) for r in lost] == [(4, 2, 2)]


def test_empty_input_counts(spark):
    tagged = quality.tagged(bronze(spark).limit(0))
    assert tuple(quality.retention(quality.reason_counts(tagged)).first()) == (0, 0, 0, None)
    assert [r["passed"] for r in quality.checks(tagged).collect()] == [False, False, True, True]


def test_replay_keeps_the_recorded_rank(spark):
    data = bronze(spark, {"trip_id": "A", "trip_seconds": "30000"}, {"trip_id": "B"}, {"trip_id": "B", "trip_total": "1"})
    quarantine = quality.quarantine_of(quality.tagged(data))
    again = by_note(quality.replay(quarantine, Thresholds(max_seconds=40000)), "reject_reason")
    assert again == {"0": "valid", "2": "duplicate_trip_id"}
