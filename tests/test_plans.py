"""What the physical plans must look like, whatever the data."""

from datetime import date

import pytest

from tests.conftest import TEST_DATA
from tests.helpers import raw
from tripmill.operators import enrich, gold, quality, serve
from tripmill.plans import medallion as M
from tripmill.plans import queries as Q
from tripmill.sources.lake import Lake

SF = f"{TEST_DATA}/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("plans")))
    M.run_all(spark, raw(spark, {}, {"trip_id": "B", "fare": "-1"}), lake)
    return lake


def test_tagging_shuffles_only_repeated_ids_and_once(spark, lake, tmp_path):
    assert "Exchange" not in plan(quality.tagged(M.read_bronze(spark, lake)))
    other = Lake(str(tmp_path))
    M.write_bronze(raw(spark, {}, {"trip_total": "1"}, *({"trip_id": f"B{i}"} for i in range(6))), other)
    text = plan(quality.tagged(M.read_bronze(spark, other)))
    assert text.count("Exchange hashpartitioning(trip_id") == 1 and text.count("BroadcastExchange") == 2
    assert text.count("Exchange") == 3 and "LeftAnti" in text and "LeftSemi" in text


def test_silver_keeps_one_row_per_id_before_the_shuffle(spark, lake):
    text = plan(quality.silver(M.read_bronze(spark, lake)))
    assert text.count("Exchange") == 1
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below


def test_gold_reads_only_its_columns_and_days(spark, lake):
    silver = M.read_silver(spark, lake)
    zones = plan(gold.pickup_zones(silver))
    schema = zones[zones.index("ReadSchema") :].split("\n")[0]
    assert "trip_total" in schema and "fare" not in schema and "trip_id" not in schema
    text = plan(gold.revenue_by(silver.filter("trip_date = date'2023-10-08'")))
    assert "PartitionFilters: [isnotnull(trip_date" in text
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_dimensions_are_broadcast_by_their_size(spark):
    zones = serve.zones(Q.zones(spark, SF))
    assert "BroadcastHashJoin" in plan(enrich.with_zone_names(zones, Q.areas(spark, SF)))


def test_top_n_needs_no_full_sort(spark, lake):
    silver = M.read_silver(spark, lake)
    assert "TakeOrderedAndProject" in plan(serve.top_revenue_days(gold.revenue_by(silver)))


@pytest.mark.parametrize("key", ["quality_tagged", "gold_revenue_by_day", "gold_avg_trip_duration", "event_days"])
def test_no_python_in_the_data_path(spark, key):
    text = plan(Q.all_queries()[key](spark, SF))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_period_filter_reaches_the_scan(spark, lake):
    stored = spark.read.parquet(lake.gold(M.REVENUE))
    text = plan(serve.revenue_by_day(stored, date(2023, 10, 1), date(2023, 10, 9)))
    assert "GreaterThanOrEqual(trip_date" in text
