"""What a task reads and what is shuffled must not depend on fixed numbers of ranges or partitions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import BASE, bronze, rows
from tests.test_dedup import skewed
from tripmill.operators import dedup, id_bits
from tripmill.operators.dedup import CopyPolicy
from tripmill.operators.ingest import typed
from tripmill.plans import medallion as M
from tripmill.plans import queries as Q
from tripmill.sources import trip_index
from tripmill.sources.lake import Lake
from tripmill.sources.staging import move
from tripmill.streaming import jobs


def many(spark, n=60, tasks=12):
    """Trips of one year, in so many tasks."""
    columns = [F.lit(value).alias(name) for name, value in BASE.items() if name != "trip_id"]
    return spark.range(0, n, 1, tasks).select(F.concat(F.lit("T"), "id").alias("trip_id"), *columns)


def files(spark, path):
    return len(spark.read.parquet(path).select(F.input_file_name()).distinct().collect())


@pytest.fixture
def yearly(tmp_path):
    return Lake(str(tmp_path / "lake"), grain="year")


def test_landed_files_are_as_many_as_tasks(spark, monkeypatch):
    monkeypatch.setattr(Q, "trips", lambda spark, folder: many(spark))
    stream, lake = Q._landed(spark, "")
    assert files(spark, lake.path("landing")) == 12
    assert stream.isStreaming


def test_stream_spreads_a_year_over_all_tasks(spark, yearly):
    many(spark).write.parquet(yearly.path("landing"))
    stream = jobs.landed_files(spark, yearly.path("landing"), many(spark).schema)
    jobs.land_bronze(stream, yearly, yearly.path("ck")).awaitTermination()
    assert files(spark, yearly.bronze) > 4
    assert rows(M.read_bronze(spark, yearly).select(many(spark).columns)) == rows(many(spark))


@pytest.mark.parametrize("policy", [CopyPolicy(stored=True), CopyPolicy(stored=True, hot_rows=50), CopyPolicy(stored=True, broadcast_ids=0, hot_rows=50)])
def test_ranks_behind_a_bitmap_are_those_of_a_plain_window(spark, policy):
    single = bronze(spark, *({"trip_id": f"S{i}"} for i in range(900)))
    data = skewed(spark).unionByName(typed(single)).repartition(5)
    order = Window.partitionBy("trip_id").orderBy(*dedup.newest_first(data))
    place = F.when(F.col("trip_id").isNotNull(), F.row_number().over(order)).cast("bigint")
    found = dedup.ranked(data, policy=policy)
    assert rows(found) == rows(data.withColumn("_duplicate_rank", place))
    assert "_bitmap" in found._jdf.queryExecution().analyzed().toString()


def test_bitmaps_find_every_id_and_few_others(spark):
    ids = spark.range(0, 20000).select(F.concat(F.lit("T"), "id").alias("trip_id"))
    inside, outside = ids.filter("trip_id < 'T5'"), ids.filter("trip_id >= 'T5'")
    bits = id_bits.bits_for(inside.count(), 1 << 20)
    assert bits % 32768 == 0 and bits >= 8 * inside.count()
    held = id_bits.bitmaps(inside.unionByName(spark.createDataFrame([(None,)], "trip_id string")), "trip_id", bits)
    assert id_bits.marked(inside, "trip_id", held, bits, "m").filter("m").count() == inside.count()
    strays = id_bits.marked(outside, "trip_id", held, bits, "m").filter("m").count() / outside.count()
    assert strays < 1.5 * id_bits.false_share(inside.count(), bits)
    null = spark.createDataFrame([(None,)], "trip_id string")
    assert [r.m for r in id_bits.marked(null, "trip_id", held, bits, "m").collect()] == [False]


def test_bits_keep_to_their_bound():
    assert id_bits.bits_for(0, 1 << 20) == 32768
    assert id_bits.bits_for(10**9, 1 << 20) == 8 << 20
    assert id_bits.false_share(10**9, 8 << 20) > 0.99


def test_years_are_written_without_a_shuffle_by_partition(spark, yearly):
    assert M.write_bronze(many(spark), yearly) == 60
    assert files(spark, yearly.bronze) == 12
    daily = Lake(yearly.root + "-daily")
    M.write_bronze(many(spark), daily)
    assert files(spark, daily.bronze) == 1
    assert rows(M.read_bronze(spark, daily)) == rows(M.read_bronze(spark, yearly).select(M.read_bronze(spark, daily).columns))


def test_a_batch_is_indexed_once(spark, yearly, monkeypatch):
    appended = []
    monkeypatch.setattr(trip_index, "append", lambda *given: appended.append(given))
    many(spark).write.parquet(yearly.path("landing"))
    stream = jobs.landed_files(spark, yearly.path("landing"), many(spark).schema)
    jobs.land_bronze(stream, yearly, yearly.path("ck/bronze")).awaitTermination()
    jobs.refresh_silver(spark, yearly, yearly.path("ck/silver")).awaitTermination()
    assert appended == [] and trip_index.read(spark, yearly).count() == 60
    assert M.read_silver(spark, yearly).count() == 60


def test_arrivals_are_moved_and_never_merged(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}")
    move(spark, f"{tmp_path}/a", f"{tmp_path}/to/x")
    assert spark.read.parquet(f"{tmp_path}/to/x").count() == 3
    with pytest.raises(OSError):
        move(spark, f"{tmp_path}/b", f"{tmp_path}/to/x")
    move(spark, f"{tmp_path}/none", f"{tmp_path}/to/y")
