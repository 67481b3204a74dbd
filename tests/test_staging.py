import os

import pytest

from tripmill.session import object_store
from tripmill.sources.lake import Lake
from tripmill.sources.staging import shared_dir, staged, staging_scope


def folder_of(df) -> str:
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_staged_tables_are_read_back_and_deleted_with_their_scope(spark):
    kept = staged(spark.range(5), "kept")
    with staging_scope(spark):
        inner = staged(spark.range(3), "inner")
        path = folder_of(inner)
        assert inner.count() == 3 and path.startswith(shared_dir(spark))
    assert not os.path.exists(path)
    assert kept.count() == 5 and kept.columns == ["id"]


def test_scope_deletes_after_a_failure(spark):
    with pytest.raises(RuntimeError):
        with staging_scope(spark):
            path = folder_of(staged(spark.range(3), "failed"))
            raise RuntimeError
    assert not os.path.exists(path)


def test_what_outlives_a_scope_goes_with_the_next(spark):
    with staging_scope(spark):
        with staging_scope(spark):
            inner = folder_of(staged(spark.range(3), "inner"))
            held = staged(spark.range(4), "held", outlives=True)
        assert not os.path.exists(inner) and held.count() == 4
        with staging_scope(spark):
            pass
        path = folder_of(held)
        assert os.path.exists(path)
    assert not os.path.exists(path)
    with staging_scope(spark):
        last = staged(spark.range(5), "last", outlives=True)
    assert last.count() == 5


def test_the_shared_folder_is_that_of_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_object_store_settings_hold_no_credentials():
    settings = object_store("http://store:9000")
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not any("key" in name or "secret" in name for name in settings)


def test_lake_refuses_unknown_grains_and_formats():
    with pytest.raises(ValueError):
        Lake("x", grain="hour")
    with pytest.raises(ValueError):
        Lake("x", format="delta")
