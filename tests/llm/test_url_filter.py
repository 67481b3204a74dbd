import pytest
from pyspark.sql import functions as F

from tripmill.llm import url_filter
from tripmill.llm.url_filter import Cascade, Rule

URLS = {
    None: ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "example.org/es/1": ("", "", None, "allow"),
    "http://": ("", "", None, "allow"),
    "http://example.org": ("example.org", "", None, "allow"),
    "http://example.org/": ("example.org", "/", "org/", "allow"),
    "https://Example.ORG/es/x?y#z": ("example.org", "/es/x", "example.org/es/", "block"),
    "http://a.b.example.org/en/12": ("a.b.example.org", "/en/12", "example.org/en/1", "block"),
    "http://a.example.org/en/21": ("a.example.org", "/en/21", "org/", "allow"),
    "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
    "http://x.com/fr/1": ("x.com", "/fr/1", "com/fr/", "allow"),
    "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
    "http://x.com/de": ("x.com", "/de", None, "allow"),
    "http://com/de/a": ("com", "/de/a", "com/de/", "block"),
    "http://x.com:80/de/a": ("x.com:80", "/de/a", None, "allow"),
    "http://x.com?/de/a": ("x.com", "", None, "allow"),
    "http://x.com#/de/a": ("x.com", "", None, "allow"),
    "a://b://c.com/de/": ("b:", "//c.com/de/", None, "allow"),
    "http://É.org/x": ("É.org", "/x", "org/", "allow"),
    "http://x.net/" + "y" * 30_000: ("x.net", "/" + "y" * 30_000, None, "allow"),
}


def test_rules(spark):
    rows = [(i, u, None, "h") for i, u in enumerate([*URLS, *URLS])]
    pages = spark.createDataFrame(rows, "page_id long, url string, path string, host string")
    found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages).collect()}
    assert found == dict(enumerate([*URLS.values(), *URLS.values()]))


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([(None, "http://a.org/x")], "page_id long, url string")
    assert url_filter.judge(pages.limit(0)).collect() == []
    assert [tuple(r) for r in url_filter.judge(pages, rules=()).collect()] == [(None, "a.org", "/x", None, "allow")]


def test_equally_long_rules(spark):
    rules = (Rule("org", "/abc", "block"), Rule("a.org", "/a", "allow"))
    pages = spark.createDataFrame([(1, "http://a.org/abc")], "page_id long, url string")
    assert url_filter.judge(pages, rules).first()["rule"] == "a.org/a"


@pytest.mark.parametrize("listed", [1, 40, 700])
def test_cascade_is_exact_over_its_universe(spark, listed):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    members = universe.where(F.pmod(F.xxhash64("key"), F.lit(20_000)) < listed)
    cascade = Cascade(members, universe)
    assert len(cascade.levels) > 1 or listed == 1
    wanted = {r[0] for r in members.collect()}
    assert {r[0] for r in universe.where(cascade.lists(F.col("key"))).collect()} == wanted


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    plan = url_filter.judge(pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan.split("== Physical Plan ==")[1]
