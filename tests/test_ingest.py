import os
import subprocess
import sys
from datetime import date, timedelta

import pytest

from tests.conftest import ROOT
from tests.helpers import bronze, rows
from tripmill.operators import ingest

END = date(2023, 12, 31)
START = "trip_start_timestamp"


def day(n: int, **change) -> dict:
    return {START: f"2023-10-{n:02d} 10:00:00", "trip_id": f"D{n}", "note": "n", **change}


def test_a_second_run_adds_nothing(spark):
    all_rows = bronze(spark, day(1), day(2), day(2, trip_id=None), day(2, trip_id=None), day(3))
    stored = ingest.new_rows(all_rows.limit(0), all_rows, END)
    assert rows(stored) == rows(all_rows)
    assert ingest.new_rows(stored, all_rows, END).count() == 0


def test_a_group_cut_in_two_is_completed(spark):
    last = [day(2), day(2, trip_id=None), day(2, trip_id="X"), day(2, trip_id="X")]
    stored, everything = bronze(spark, day(1), last[0], last[2]), bronze(spark, day(1), *last, day(3))
    assert rows(ingest.appended(stored, everything, END)) == rows(everything)


def test_older_rows_need_a_lookback(spark):
    stored, everything = bronze(spark, day(1), day(5)), bronze(spark, day(1), day(4), day(5))
    assert ingest.new_rows(stored, everything, END).count() == 0
    late = ingest.new_rows(stored, everything, END, lookback=timedelta(days=2))
    assert [r["trip_id"] for r in late.collect()] == ["D4"]


def test_period_is_inclusive_and_batches_are_the_earliest_rows(spark):
    everything = bronze(spark, *[day(n) for n in range(1, 8)], {START: "2023-10-07 23:59:59.9", "trip_id": "L"})
    chosen = ingest.new_rows(everything.limit(0), everything, date(2023, 10, 7), start=date(2023, 10, 2))
    assert sorted(r["trip_id"] for r in chosen.collect()) == ["D2", "D3", "D4", "D5", "D6", "D7", "L"]
    batch = ingest.new_rows(everything.limit(0), everything, END, batch_rows=3)
    assert [r["trip_id"] for r in batch.collect()] == ["D1", "D2", "D3"]
    capped = ingest.new_rows(bronze(spark, day(1), day(2)), everything, END, batch_rows=3, total_rows=4)
    assert [r["trip_id"] for r in capped.collect()] == ["D3", "D4"]


def test_malformed_starts_are_taken_once(spark):
    everything = bronze(spark, day(1), day(2, **{START: "nope"}), day(2, **{START: "nope"}), day(3, **{START: None}))
    stored = ingest.new_rows(everything.limit(0), everything, END)
    assert rows(stored) == rows(everything)
    assert ingest.new_rows(bronze(spark, day(1), day(2, **{START: "nope"})), everything, END).count() == 2
    assert ingest.new_rows(stored, everything, END).count() == 0
    assert ingest.new_rows(everything.limit(0), everything, END, batch_rows=3).filter("trip_date is null").count() == 3


def test_rows_left_out_are_counted(spark):
    everything = bronze(spark, day(1), day(2), day(3), day(3), day(9), day(4, **{START: "nope"}))
    found = ingest.not_taken(bronze(spark, day(3)), everything, date(2023, 10, 8)).first()
    assert tuple(found) == (1, 2, 3)


ZONES = """
import sys
sys.path.insert(0, {root!r})
from datetime import date
from tests.conftest import new_session
from tests.helpers import bronze
from tripmill.operators import ingest
spark = new_session()
spark.conf.set("spark.sql.session.timeZone", {zone!r})
day = lambda n, hour: {{"trip_start_timestamp": f"2023-10-{{n:02d}} {{hour:02d}}:00:00", "trip_id": f"D{{n}}-{{hour}}"}}
stored, incoming = bronze(spark, day(3, 10)), bronze(spark, day(3, 10), day(3, 12), day(4, 23), day(5, 0))
print("IDS", *sorted(r["trip_id"] for r in ingest.new_rows(stored, incoming, date(2023, 10, 4)).collect()))
print("IDS", *sorted(r["trip_id"] for r in ingest.new_rows(stored, incoming, date(2023, 10, 4), batch_rows=1).collect()))
"""


@pytest.mark.parametrize(("process", "zone"), [("America/Chicago", "UTC"), ("Asia/Tokyo", "America/Chicago")])
def test_time_zones_change_nothing(process, zone):
    code = ZONES.format(root=ROOT, zone=zone)
    done = subprocess.run([sys.executable, "-c", code], env={**os.environ, "TZ": process}, capture_output=True, text=True, timeout=300)
    assert [x.split()[1:] for x in done.stdout.splitlines() if x.startswith("IDS")] == [["D3-12", "D4-23"], ["D3-12"]], done.stderr[-2000:]


def test_stored_rows_are_read_by_day(spark, tmp_path):
    bronze(spark, *[day(n) for n in range(1, 9)]).write.partitionBy("trip_date").parquet(f"{tmp_path}/bronze")
    stored = spark.read.parquet(f"{tmp_path}/bronze")
    plan = ingest.new_rows(stored, bronze(spark, day(9)), END, batch_rows=5)._jdf.queryExecution().toString()
    assert "2023-10-08" in plan.split("PartitionFilters: ")[1] + plan.split("PartitionFilters: ")[-1] and "Window" not in plan


@pytest.mark.parametrize("batch_rows", [2, 3])
def test_batches_reach_the_end_even_inside_a_group(spark, batch_rows):
    everything = bronze(spark, day(1), *[day(2, note=str(i)) for i in range(5)], day(3)).cache()
    stored = everything.limit(0)
    for _ in range(10):
        fresh = ingest.new_rows(stored, everything, END, batch_rows=batch_rows)
        got = [tuple(r) for r in fresh.collect()]
        if not got:
            break
        stored = stored.unionByName(spark.createDataFrame(got, everything.schema))
    assert rows(stored) == rows(everything)
