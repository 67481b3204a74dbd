"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_module
from tests.conftest import TEST_DATA
from tests.oracle_check import connect, differences
from tripmill.plans import oracle
from tripmill.plans.queries import all_queries

SF = f"{TEST_DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF) as c:
        yield c


def test_every_query_has_sql():
    assert set(all_queries()) == set(oracle.sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("key", list(oracle.sql()))
def test_query_equals_its_sql(spark, con, key):
    assert differences(spark, con, SF, key) == []


def test_reject_counts_match_the_published_table(spark):
    # FIXTURES.md, section 2, sf 0.001
    expected = {
        "null_trip_id": 98, "duplicate_trip_id": 1361, "invalid_timestamp": 89, "invalid_duration": 250,
        "invalid_distance": 127, "invalid_speed": 115, "negative_amount": 273, "missing_geography": 247, "valid": 3440,
    }
    found = entry_module.queries()["quality_reject_counts"](spark, SF).collect()
    assert {r["reject_reason"]: r["n_rows"] for r in found} == expected


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1846
