"""Registered queries against their SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_module
from tests.conftest import TEST_DATA
from tests.oracle_check import connect, differences
from tripmill.llm import queries, sql

SF = f"{TEST_DATA}/sf0.001"


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry_module.queries())
    assert {int(name[2:].split("_")[0]) for name in queries.queries()} == set(range(1, 14))


@pytest.mark.parametrize("key", list(sql.SQL))
def test_query_equals_its_sql(spark, key):
    with connect(SF) as con:
        assert differences(spark, con, SF, key) == []
