import numpy as np
import pytest

from tripmill.llm import files


@pytest.mark.parametrize("most", [files.MOST_SHARDS, 3])
def test_bounds_are_bounded_and_repeatable(spark, monkeypatch, most):
    monkeypatch.setattr(files, "MOST_SHARDS", most)
    shards = min(10, most)
    df = spark.range(20_000).withColumnRenamed("id", "key")
    bounds = files.shard_bounds(df, "key", 10, 20_000)
    assert len(bounds) == shards - 1 and (np.diff(bounds) > 0).all()
    sizes = np.diff(np.r_[0, bounds, 20_000])
    assert sizes.max() < 2 * 20_000 / shards
    assert (files.shard_bounds(df.repartition(7), "key", 10, 20_000) == bounds).all()


def test_repeated_and_missing_keys(spark):
    rows = [(None,)] * 500 + [(5,)] * 500 + [(i,) for i in range(200)]
    df = spark.createDataFrame(rows, "key long")
    bounds = files.shard_bounds(df, "key", 4, len(rows))
    assert len(bounds) and len(bounds) == len(set(bounds.tolist())) <= 3
    none = spark.createDataFrame([(None,)] * 9, "key long")
    assert not len(files.shard_bounds(none, "key", 4, 9))
    assert not len(files.shard_bounds(none.limit(0), "key", 4, 0))
