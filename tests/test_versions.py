"""Silver and quarantine come into force together or not at all."""

import pytest

from tests.helpers import raw, rows
from tests.test_lake import SAMPLE, day, tables
from tripmill.operators.quality import Thresholds
from tripmill.plans import medallion as M
from tripmill.schema import ContractError
from tripmill.sources import lake as L
from tripmill.sources import versions as V
from tripmill.sources.lake import Lake

STRICT = Thresholds(min_seconds=5000)


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    M.write_bronze(raw(spark, *SAMPLE), lake)
    M.run_silver(spark, lake)
    return lake


class Stop(Exception):
    pass


def stop(*_, **__):
    raise Stop


STEPS = [  # where a run stops, and whether its rows are in force by then
    (V, "write", False), (V, "_counted", False), (M, "_run_of", False), (M, "_reconciled", False), (V, "publish", False),
    (L, "write_metrics", True), (V, "vacuum", True),
]


@pytest.mark.parametrize(("module", "step", "published"), STEPS)
def test_a_run_that_stops_leaves_whole_tables(spark, lake, monkeypatch, module, step, published):
    before = tables(spark, lake)
    with monkeypatch.context() as patch:
        patch.setattr(module, step, stop)
        with pytest.raises(Stop):
            M.run_silver(spark, lake, Thresholds(min_seconds=0, min_miles=-1))
    assert (tables(spark, lake) != before) == published
    assert M.reconcile(spark, lake).count() == 0
    if not published:
        assert len(L.subfolders(spark, f"{lake.silver}/runs")) == 1  # what the run had written is gone
    M.run_silver(spark, lake, Thresholds(min_seconds=0, min_miles=-1))
    assert tables(spark, lake) != before and M.reconcile(spark, lake).count() == 0


def test_a_version_file_that_was_not_renamed_counts_for_nothing(spark, lake, monkeypatch):
    before = tables(spark, lake)
    version = V.current(spark, lake)
    fs, path = V.file_system(spark, f"{lake.silver}/versions/_2-abandoned")
    fs.create(path).close()
    assert V.current(spark, lake) == version and tables(spark, lake) == before


def test_two_runs_from_one_version_cannot_both_publish(spark, lake):
    version = V.current(spark, lake)
    V.publish(spark, lake, V.Version(version.number + 1, version.runs, version.written))
    with pytest.raises(V.ConflictError):
        V.publish(spark, lake, V.Version(version.number + 1))
    assert V.current(spark, lake).runs == version.runs
    assert not [n for n in V.numbers(spark, lake) if n > version.number + 1]


def test_readers_of_the_version_before_go_on(spark, lake):
    silver, before = M.read_silver(spark, lake), tables(spark, lake)[0]
    M.run_silver(spark, lake, STRICT, partitions=[day_of(2)])
    assert rows(silver) == before != tables(spark, lake)[0]


def day_of(n):
    from datetime import date

    return date(2023, 10, n)


def test_old_versions_go_and_their_partitions_with_them(spark, lake):
    first = set(L.subfolders(spark, f"{lake.silver}/runs"))
    for n in (1, 2, 3, 4):
        M.run_silver(spark, lake, partitions=[day_of(n)])
    assert len(V.numbers(spark, lake)) == V.KEPT
    kept = {p for v in V.numbers(spark, lake) for p in V.load(spark, lake, v).runs.get(first.copy().pop().split("=")[1], ())}
    stored = {p for r in L.subfolders(spark, f"{lake.silver}/runs/{min(first)}") for p in L.subfolders(spark, f"{lake.silver}/runs/{min(first)}/{r}")}
    assert stored == kept and f"{lake.partition}=2023-10-02" not in kept
    M.run_silver(spark, lake)
    M.run_silver(spark, lake)
    assert first.isdisjoint(L.subfolders(spark, f"{lake.silver}/runs"))
    assert M.reconcile(spark, lake).count() == 0


def test_reads_name_whole_runs_and_prune_partitions(spark, lake):
    assert V.current(spark, lake).folders(True) == [f"{V.RUN}={next(iter(V.current(spark, lake).runs))}/reject_reason=valid"]
    M.run_silver(spark, lake, partitions=[day_of(1)])
    plan = M.read_silver(spark, lake).filter("trip_date = date'2023-10-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trip_date" in plan and "reject_reason" not in plan.split("ReadSchema")[1]


def test_one_write_serves_both_tables(spark, lake, monkeypatch):
    plans = []
    hint = type(spark.range(1)).hint

    def seen(self, name, *by):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return hint(self, name, *by)

    monkeypatch.setattr(type(spark.range(1)), "hint", seen)
    M.run_silver(spark, lake)
    assert len(plans) == 1 and "trip_start_timestamp:string" in plans[0]  # raw rows of bronze, not a staged copy of typed ones


def test_metrics_of_one_run_are_one_row_even_if_it_is_read_late(spark, lake):
    row = L.read_metrics(spark, lake).first().asDict()
    L.write_metrics(spark, lake, row)
    L.write_metrics(spark, lake, {**row, "run_id": "other/run #1"})
    assert L.read_metrics(spark, lake).count() == 2


def test_an_empty_partition_is_dropped_and_no_valid_row_publishes_nothing(spark, lake):
    number = V.current(spark, lake).number
    with pytest.raises(ContractError, match="no row is valid"):
        M.run_silver(spark, lake, STRICT)
    assert V.current(spark, lake).number == number
    L.delete(spark, f"{lake.bronze}/trip_date=2023-10-02")
    assert M.run_silver(spark, lake, partitions=[day_of(2)]).bronze_rows == 0
    assert M.reconcile(spark, lake).count() == 0
    assert day_of(2) not in {r["trip_date"] for r in M.read_silver(spark, lake).collect()}
