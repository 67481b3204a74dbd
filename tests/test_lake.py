from datetime import date

import pytest

from tests.helpers import raw, rows
from tripmill.operators import quality
from tripmill.operators.quality import Thresholds
from tripmill.plans import medallion as M
from tripmill.schema import ContractError
from tripmill.sources import lake as L
from tripmill.sources.lake import Lake


def day(n: int, i: int = 0, **change) -> dict:
    start = f"2023-10-{n:02d} 10:00:00"
    return {"trip_id": f"D{n}-{i}", "trip_start_timestamp": start, "trip_end_timestamp": start, "note": f"{n}{i}", **change}


SAMPLE = [
    day(1), day(1, 1), day(1, 2, fare="-1"),
    day(2), day(2, 1, trip_seconds="0"),
    day(3), day(3, 1, trip_id="D1-0"),  # a later copy of a trip of day 1
    day(4, trip_id=None),
    day(5, trip_start_timestamp="nope"),
]


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def tables(spark, lake):
    return rows(M.read_silver(spark, lake)), rows(M.read_quarantine(spark, lake))


def test_full_run_splits_and_reconciles(spark, lake):
    assert M.write_bronze(raw(spark, *SAMPLE), lake) == 9
    run = M.run_silver(spark, lake)
    assert (run.bronze_rows, run.silver_rows, run.rejected_rows) == (9, 4, 5)
    assert run.rejection_counts == {
        "negative_amount": 1, "invalid_duration": 1, "duplicate_trip_id": 1, "null_trip_id": 1, "invalid_timestamp": 1,
    }
    bronze = M.read_bronze(spark, lake)
    expected = quality.split(quality.tagged(bronze))
    assert tables(spark, lake) == tuple(rows(df) for df in expected)
    assert M.reconcile(spark, lake).count() == 0


def test_identical_rerun_changes_nothing(spark, lake):
    M.write_bronze(raw(spark, *SAMPLE), lake)
    M.run_silver(spark, lake)
    before = tables(spark, lake)
    M.run_silver(spark, lake)
    assert tables(spark, lake) == before


def test_one_day_rerun_sees_copies_on_other_days(spark, lake):
    M.write_bronze(raw(spark, *SAMPLE), lake)
    M.run_silver(spark, lake)
    before = tables(spark, lake)
    run = M.run_silver(spark, lake, partitions=[date(2023, 10, 1)])
    assert run.bronze_rows == 3 and run.rejection_counts["duplicate_trip_id"] == 1
    assert tables(spark, lake) == before
    assert M.run_silver(spark, lake, partitions=[None]).rejection_counts == {"invalid_timestamp": 1}
    assert tables(spark, lake) == before


def test_a_day_that_becomes_invalid_leaves_no_stale_rows(spark, lake):
    M.write_bronze(raw(spark, *SAMPLE), lake)
    M.run_silver(spark, lake)
    strict = Thresholds(min_seconds=5000)
    run = M.run_silver(spark, lake, strict, partitions=[date(2023, 10, 2)])
    assert run.silver_rows == 0
    days = {r["trip_date"] for r in M.read_silver(spark, lake).collect()}
    assert days == {date(2023, 10, 1), date(2023, 10, 3)}
    assert M.reconcile(spark, lake).count() == 0
    relaxed = M.run_silver(spark, lake, Thresholds(min_seconds=0, min_miles=-1), partitions=[date(2023, 10, 2)])
    assert relaxed.silver_rows == 1 and M.reconcile(spark, lake).count() == 0


def test_full_run_clears_days_that_left_bronze(spark, lake):
    M.write_bronze(raw(spark, *SAMPLE), lake)
    M.run_silver(spark, lake)
    M.write_bronze(raw(spark, day(2)), lake)
    M.run_silver(spark, lake)
    assert M.read_silver(spark, lake).count() == 1 and M.read_quarantine(spark, lake).count() == 0
    assert M.reconcile(spark, lake).count() == 0


def test_no_rejects_leaves_a_readable_quarantine(spark, lake):
    M.write_bronze(raw(spark, day(1), day(2)), lake)
    assert M.run_silver(spark, lake).rejection_counts == {}
    assert M.read_quarantine(spark, lake).count() == 0


def test_refused_input_writes_nothing(spark, lake):
    M.write_bronze(raw(spark, day(1, fare="-1")), lake)
    with pytest.raises(ContractError, match="no row is valid"):
        M.run_silver(spark, lake)
    assert not L.exists(spark, lake.silver)
    M.write_bronze(raw(spark, day(1)).drop("tips", "fare"), Lake(lake.root + "2"))
    with pytest.raises(ContractError, match="fare, tips"):
        M.run_silver(spark, Lake(lake.root + "2"))
    M.write_bronze(raw(spark, day(1)), lake)
    L.delete(spark, f"{lake.bronze}/trip_date=2023-10-01")
    spark.createDataFrame([], M.ingest.with_trip_date(raw(spark, day(1))).schema).drop("trip_date").write.mode(
        "append"
    ).parquet(f"{lake.bronze}/trip_date=2023-10-01")
    with pytest.raises(ContractError, match="bronze has no rows"):
        M.run_silver(spark, lake)


def test_session_setting_is_left_alone(spark, lake):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    M.run_all(spark, raw(spark, *SAMPLE), lake)
    assert spark.conf.get(key) == before


def test_verification_finds_a_lost_row(spark, lake, monkeypatch):
    M.write_bronze(raw(spark, *SAMPLE), lake)
    M.run_silver(spark, lake)
    before = tables(spark, lake)
    tagged = quality.tagged
    monkeypatch.setattr(quality, "tagged", lambda *a, **k: tagged(*a, **k).filter("note <> '20'"))
    with pytest.raises(ContractError, match="2023-10-02: 1 written, 2 in bronze"):
        M.run_silver(spark, lake)
    assert tables(spark, lake) == before


def test_gold_and_its_refresh(spark, lake):
    M.run_all(spark, raw(spark, *SAMPLE), lake)
    names = [M.REVENUE, M.DURATION, M.ZONES]
    before = {n: rows(spark.read.parquet(lake.gold(n))) for n in names}
    assert spark.read.parquet(lake.gold(M.REVENUE)).count() == 3
    M.refresh_gold(spark, lake, [date(2023, 10, 1), date(2023, 10, 2)])
    assert {n: rows(spark.read.parquet(lake.gold(n))) for n in names} == before
    L.register_gold(spark, lake, names)
    assert spark.sql(f"select sum(nb_trips) from {M.REVENUE}").first()[0] == 4


def test_metrics_history(spark, lake):
    M.write_bronze(raw(spark, *SAMPLE), lake)
    M.run_silver(spark, lake)
    M.run_silver(spark, lake, partitions=[date(2023, 10, 2)])
    history = M.metrics_history(L.read_metrics(spark, lake)).orderBy("finished_at").collect()
    assert [r["bronze_rows"] for r in history] == [9, 2]
    assert [r["bronze_rows_change"] for r in history] == [None, -7]
    assert history[0]["rejection_counts"]["null_trip_id"] == 1


def test_append_completes_bronze(spark, lake):
    first, everything = raw(spark, *SAMPLE[:4]), raw(spark, *SAMPLE)
    end = date(2023, 12, 31)
    assert M.append_bronze(first, lake, end) == 4
    assert M.append_bronze(everything, lake, end) == 5  # also the row without a start, for the quarantine
    assert M.append_bronze(everything, lake, end) == 0
    assert M.run_silver(spark, lake).rejection_counts["invalid_timestamp"] >= 1


def test_month_grain_keeps_the_day(spark, tmp_path):
    lake = Lake(str(tmp_path), grain="month")
    M.run_all(spark, raw(spark, *SAMPLE), lake)
    silver = M.read_silver(spark, lake)
    assert {r["trip_month"] for r in silver.collect()} == {date(2023, 10, 1)}
    assert silver.select("trip_date").distinct().count() == 3
    assert M.reconcile(spark, lake).count() == 0
