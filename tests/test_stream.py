import time
from contextlib import nullcontext
from pathlib import Path

import pytest

from tests.helpers import raw, rows
from tests.test_lake import SAMPLE, day
from tripmill.operators import quality
from tripmill.plans import medallion as M
from tripmill.plans import queries as Q
from tripmill.session import STATE, STORES_PER_CORE, state_on_disk
from tripmill.sources.lake import Lake
from tripmill.streaming import jobs


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def land(spark, lake, *changes):
    raw(spark, *changes).coalesce(1).write.mode("append").parquet(lake.path("landing"))


def refresh(spark, lake, **options):
    schema = raw(spark).schema
    stream = jobs.landed_files(spark, lake.path("landing"), schema, files_per_batch=1)
    jobs.land_bronze(stream, lake, lake.path("ck/bronze")).awaitTermination()
    jobs.refresh_silver(spark, lake, lake.path("ck/silver"), **options).awaitTermination()


def assert_like_batch(spark, lake):
    bronze = M.read_bronze(spark, lake)
    silver, quarantine = quality.split(quality.tagged(bronze))
    assert rows(M.read_silver(spark, lake)) == rows(silver)
    assert rows(M.read_quarantine(spark, lake)) == rows(quarantine)
    assert M.reconcile(spark, lake).count() == 0


def test_stream_equals_batch_after_every_arrival(spark, lake):
    land(spark, lake, *SAMPLE[:5])
    refresh(spark, lake, with_gold=True)
    assert_like_batch(spark, lake)
    # a newer copy of a trip of day 1 arrives on day 3, and a late trip on day 2
    land(spark, lake, *SAMPLE[5:], day(2, 7))
    refresh(spark, lake, with_gold=True)
    assert_like_batch(spark, lake)
    assert M.read_bronze(spark, lake).count() == len(SAMPLE) + 1
    gold = spark.read.parquet(lake.gold(M.REVENUE))
    assert gold.agg({"nb_trips": "sum"}).first()[0] == M.read_silver(spark, lake).count()
    before = rows(M.read_silver(spark, lake))
    refresh(spark, lake)
    assert rows(M.read_silver(spark, lake)) == before


def run(stream, lake, name, mode="append"):
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", lake.path(name))
        .option("checkpointLocation", lake.path(f"ck/{name}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query, stream.sparkSession.read.schema(stream.schema).parquet(lake.path(name))


def typed_stream(spark, lake):
    from tripmill.operators.ingest import typed, with_trip_date

    stream = jobs.landed_files(spark, lake.path("landing"), raw(spark).schema)
    return typed(with_trip_date(stream))


def test_first_seen_keeps_one_row_per_id(spark, lake):
    land(spark, lake, day(1), day(1, note="again"), day(2), day(3, trip_id=None))
    _, out = run(jobs.first_seen(typed_stream(spark, lake), "30 days").select("trip_id"), lake, "seen")
    assert sorted(r[0] for r in out.collect()) == ["D1-0", "D2-0"]
    land(spark, lake, day(2, note="later"), day(4))
    _, out = run(jobs.first_seen(typed_stream(spark, lake), "30 days").select("trip_id"), lake, "seen")
    assert sorted(r[0] for r in out.collect()) == ["D1-0", "D2-0", "D4-0"]


def waited(value, seconds=10):
    """Events reach listeners a little later."""
    for _ in range(seconds):
        time.sleep(1)
        if value():
            break
    return value()


def test_a_repeated_batch_leaves_one_row_of_metrics(spark, lake):
    from tripmill.sources.lake import read_metrics

    M.write_bronze(raw(spark, day(1), day(2)), lake)
    for run_id in ("a#0", "a#0", "a#1"):
        M.run_silver(spark, lake, run_id=run_id)
    assert read_metrics(spark, lake).count() == 2


def test_orc_lake_takes_a_stream(spark, tmp_path):
    lake = Lake(f"{tmp_path}/orc", format="orc")
    land(spark, lake, day(1), day(2))
    stream = jobs.landed_files(spark, lake.path("landing"), raw(spark).schema)
    jobs.land_bronze(stream, lake, lake.path("checkpoints/bronze")).awaitTermination()
    jobs.refresh_silver(spark, lake, lake.path("checkpoints/silver")).awaitTermination()
    assert M.read_silver(spark, lake).count() == 2


def test_daily_totals_and_late_rows(spark, lake):
    land(spark, lake, day(1), day(1, 1), day(2), day(9))
    dropped = jobs.DroppedRows()
    spark.streams.addListener(dropped)
    query, out = run(jobs.landed_totals(typed_stream(spark, lake), "2 days"), lake, "daily")
    assert sorted((r[0].day, r[1], r[2]) for r in out.collect()) == [(1, 2, 38.0), (2, 1, 19.0)]
    assert waited(lambda: dropped.rows(query)) == 0
    land(spark, lake, day(1, 5), day(9, 1))
    query, out = run(jobs.landed_totals(typed_stream(spark, lake), "2 days"), lake, "daily")
    assert waited(lambda: dropped.rows(query)) == 1
    spark.streams.removeListener(dropped)
    assert out.count() == 2


PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture
def plain(spark):
    """The session as one that sets nothing about state, with many partitions."""
    before = {key: spark.conf.get(key, None) for key in (*STATE, PARTITIONS)}
    for key in STATE:
        spark.conf.unset(key)
    spark.conf.set(PARTITIONS, "100")
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stores(lake, step=0):
    """Names of the files of each store of a step of the stream ``seen``."""
    folders = (Path(lake.root) / "checkpoints/seen/state" / str(step)).glob("[0-9]*")
    return [{p.name for p in folder.iterdir()} for folder in folders]


def seen(spark, lake):
    out = Q._drained(jobs.first_seen(typed_stream(spark, lake), "30 days").select("trip_id"), lake, "seen")
    return sorted(r[0] for r in out.collect())


def test_state_is_on_disk_in_few_stores_whatever_the_session_says(plain, lake):
    land(plain, lake, day(1), day(1, note="again"), day(2), day(3, trip_id=None))
    assert seen(plain, lake) == ["D1-0", "D2-0"]
    assert [plain.conf.get(key, None) for key in STATE] == [None] * len(STATE) and plain.conf.get(PARTITIONS) == "100"
    for step in (0, 1):  # snapshots of a store on disk, no logs of one on the heap
        assert len(stores(lake, step)) == STORES_PER_CORE * plain.sparkContext.defaultParallelism < 100
        assert all("1.zip" in names and not any(n.endswith(".delta") for n in names) for names in stores(lake, step))
    plain.conf.set(PARTITIONS, "3")  # a checkpoint keeps its partitions
    land(plain, lake, day(2, note="later"), day(4))
    assert seen(plain, lake) == ["D1-0", "D2-0", "D4-0"]
    assert len(stores(lake)) == STORES_PER_CORE * plain.sparkContext.defaultParallelism


def test_a_checkpoint_from_before_goes_on_with_its_store(plain, lake, monkeypatch):
    plain.conf.set(PARTITIONS, "5")
    land(plain, lake, day(1), day(2))
    with monkeypatch.context() as patched:
        patched.setattr(Q, "state_on_disk", nullcontext)
        assert seen(plain, lake) == ["D1-0", "D2-0"]
    land(plain, lake, day(2, note="later"), day(4))
    assert seen(plain, lake) == ["D1-0", "D2-0", "D4-0"]
    assert len(stores(lake)) == 5 and all("1.delta" in names and "1.zip" not in names for names in stores(lake))


def test_what_the_session_says_about_state_stays(plain):
    provider, memory = list(STATE)[0], "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
    plain.conf.set(memory, "100")
    with pytest.raises(RuntimeError), state_on_disk(plain):
        assert plain.conf.get(memory) == "100" and plain.conf.get(provider) == STATE[provider]
        raise RuntimeError
    assert plain.conf.get(memory) == "100" and plain.conf.get(provider, None) is None
