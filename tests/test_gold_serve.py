import math
import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import bronze
from tripmill.operators import gold, profile, quality, serve


@pytest.fixture(scope="module")
def silver(spark):
    pick = random.Random(11)
    changes = []
    for i in range(400):
        day = pick.randrange(1, 9)
        changes.append(
            {
                "trip_id": f"T{i}",
                "trip_start_timestamp": f"2023-10-{day:02d} 10:00:00",
                "trip_end_timestamp": f"2023-10-{day:02d} 12:00:00",
                "trip_seconds": str(pick.randrange(600, 3000)),
                "trip_miles": str(pick.randrange(1, 20) / 2),
                "fare": f"{pick.randrange(10000) / 100:.2f}",
                "trip_total": None if i % 50 == 0 else f"{pick.randrange(10000) / 100:.2f}",
                "pickup_community_area": str(pick.randrange(1, 5)),
            }
        )
    return quality.silver(bronze(spark, *changes)).cache()


def grouped(silver, key):
    groups = defaultdict(list)
    for r in silver.collect():
        groups[r[key]].append(r)
    return groups


def disc(values, p):
    values = sorted(values)
    return next(v for i, v in enumerate(values, 1) if i / len(values) >= p)


def test_revenue_by_day(silver):
    expected = grouped(silver, "trip_date")
    for row in gold.revenue_by(silver).collect():
        group = expected.pop(row["trip_date"])
        totals = [r["trip_total"] for r in group if r["trip_total"] is not None]
        assert row["nb_trips"] == len(group)
        assert math.isclose(row["total_fare"], sum(r["fare"] for r in group))
        assert math.isclose(row["total_revenue"], sum(totals))
        assert math.isclose(row["avg_trip_total"], sum(totals) / len(totals))
    assert not expected


def test_duration_by_day(silver):
    expected = grouped(silver, "trip_date")
    sketched = {r["trip_date"]: r for r in gold.duration_by_approx(silver).collect()}
    for row in gold.duration_by(silver).collect():
        minutes = [r["trip_seconds"] / 60.0 for r in expected.pop(row["trip_date"])]
        assert math.isclose(row["avg_trip_minutes"], sum(minutes) / len(minutes))
        assert row["median_trip_minutes"] == disc(minutes, 0.5)
        assert row["p90_trip_minutes"] == disc(minutes, 0.9)
        for name in ("median_trip_minutes", "p90_trip_minutes", "nb_trips", "avg_trip_miles"):
            assert row[name] == sketched[row["trip_date"]][name]
    assert not expected


def test_pickup_zones(silver):
    expected = grouped(silver, "pickup_community_area")
    for row in gold.pickup_zones(silver).collect():
        group = expected.pop(row["pickup_community_area"])
        assert row["nb_trips"] == len(group)
        assert math.isclose(row["avg_trip_seconds"], sum(r["trip_seconds"] for r in group) / len(group))
        assert math.isclose(row["avg_trip_miles"], sum(r["trip_miles"] for r in group) / len(group))
    assert not expected


def test_money_sum_is_exact_and_keeps_huge_amounts(spark):
    from tripmill.functions.columns import money_avg, money_sum

    cents = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v double")
    assert tuple(cents.agg(money_sum("v").alias("s"), money_avg("v").alias("a")).first()) == (1.0, 0.1)
    huge = spark.createDataFrame([(1e17,), (2e17,), (0.5,)], "v double")
    assert huge.agg(money_sum("v")).first()[0] == 3e17
    assert spark.createDataFrame([(0.125,)] * 8, "v double").agg(money_sum("v")).first()[0] == 1.0
    assert spark.createDataFrame([(-0.01,), (-2e6,), (5.25,)], "v double").agg(money_sum("v")).first()[0] == -1999994.76
    for parts in (1, 7):
        many = spark.range(0, 100_000, 1, parts).select(F.lit(9.999e11).alias("v"))
        assert many.agg(money_sum("v")).first()[0] == 9.999e16
        mixed = many.unionByName(spark.range(0, 1000, 1, parts).select(F.lit(0.001).alias("v")))
        assert mixed.agg(money_sum("v")).first()[0] == 9.999e16 + 1.0
    assert cents.filter("v > 1").agg(money_sum("v"), money_avg("v")).first()[:] == (None, None)


def test_global_indicators_weigh_days_by_trips(silver):
    trips = silver.collect()
    revenue, duration = gold.revenue_by(silver), gold.duration_by(silver)
    total = sum(r["trip_total"] or 0 for r in trips)
    kpis = serve.global_kpis(revenue).first()
    assert kpis["total_trips"] == 400 and math.isclose(kpis["total_revenue"], total)
    assert math.isclose(kpis["avg_revenue_per_trip"], total / 400)
    mean = serve.global_duration(duration).first()["avg_trip_minutes"]
    assert math.isclose(mean, sum(r["trip_seconds"] for r in trips) / 60 / 400)
    cards = serve.kpi_cards(revenue, duration).first()
    assert cards["trips"] == "400" and cards["duration"] == f"{mean:.1f} min"
    assert cards["revenue"] == f"${total:,.0f}" and cards["revenue_per_trip"] == f"${total / 400:,.2f}"
    assert serve.period_bounds(revenue).first()[:] == (date(2023, 10, 1), date(2023, 10, 8))


def test_period_filter_needs_both_bounds(silver):
    revenue = gold.revenue_by(silver)
    inside = serve.revenue_by_day(revenue, date(2023, 10, 3), date(2023, 10, 5)).collect()
    assert [r["trip_date"].day for r in inside] == [3, 4, 5]
    assert serve.revenue_by_day(revenue, date(2023, 10, 3)).count() == 8
    assert serve.duration_by_day(gold.duration_by(silver), None, date(2023, 10, 5)).count() == 8


def test_rankings(silver, spark):
    zones = gold.pickup_zones(silver)
    ranked = serve.zone_activity_vs_revenue(zones).collect()
    assert [r["nb_trips"] for r in ranked] == sorted((r["nb_trips"] for r in ranked), reverse=True)
    assert len(ranked) == 4 and serve.zone_activity_vs_revenue(zones, 2).count() == 2
    top = serve.top_zones_by_revenue(zones, 1).first()
    assert top["total_revenue"] == max(r["total_revenue"] for r in zones.collect())
    tied = spark.createDataFrame([(date(2023, 1, d), 5, 1.0, 1.0) for d in (3, 1, 2)], "trip_date date, nb_trips bigint, total_revenue double, avg_trip_total double")
    assert [r["trip_date"].day for r in serve.top_trip_days(tied, 2).collect()] == [1, 2]


def test_profile(spark, silver):
    identity = profile.identity(silver).first()
    assert tuple(identity) == (400, 400, 0)
    summary, seconds = profile.summary(silver).first(), profile.duration(silver).first()
    values = [r["trip_seconds"] for r in silver.collect()]
    assert (seconds["min_seconds"], seconds["max_seconds"]) == (min(values), max(values))
    points = [disc(values, p) for p in profile.PROBABILITIES]
    assert [seconds[c] for c in seconds.asDict() if c.startswith("p")] == points
    assert summary["percentiles_seconds"] == points and summary["rows"] == 400
    assert {r["measure"] for r in profile.distributions(silver).collect()} == {"seconds", "miles", "speed"}
    fastest = profile.extreme_speeds(silver, 5).collect()
    assert [r["trip_speed_mph"] for r in fastest] == sorted((r["trip_speed_mph"] for r in silver.collect()), reverse=True)[:5]


def test_speed_of_trips_without_duration_is_unknown(spark):
    still = bronze(spark, {"trip_seconds": "0"}, {"trip_seconds": "-5", "trip_id": "B"})
    from tripmill.operators.ingest import typed

    assert [r["trip_speed_mph"] for r in profile.extreme_speeds(typed(still)).collect()] == [None, None]
