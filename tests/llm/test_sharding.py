"""Shards against exact running sums in plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_documents
from tripmill.llm import sharding

LEAST = -(2**63)


def expected(rows, shards=16, whole=sharding.WHOLE):
    """Rows (doc_id, size, crc, shard, slot) of (doc_id, text)."""
    order = []
    for key, text in rows:
        data = (text or "").encode()
        group = int(hashlib.sha256(data).hexdigest()[:15], 16)
        order.append((group, LEAST if key is None else key, key, len(data) + 1, zlib.crc32(data)))
    order.sort(key=lambda r: r[:2])
    total, largest = sum(r[3] for r in order), max(r[3] for r in order)
    most, bytes_of = max(largest, total // (shards * whole)), Counter()
    for r in order:
        bytes_of[r[0]] += r[3]
    out, at, first, slots = [], 0, {}, Counter()
    for group, _, key, size, crc in order:
        first.setdefault(group, at)
        begin, wide = (first[group], bytes_of[group]) if bytes_of[group] <= most else (at, size)
        shard = (2 * begin + wide) * shards // (2 * total)
        out.append((key, size, crc, shard, slots[shard]))
        slots[shard], at = slots[shard] + 1, at + size
    return out


def check(df, shards=16):
    got = sharding.documents(df, shards).collect()
    want = expected([tuple(r) for r in df.select("doc_id", "text").collect()], shards)
    assert sorted(repr((r.doc_id, r.size, r.text_crc32, r.shard, r.slot)) for r in got) == sorted(map(repr, want))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sums = Counter()
    for r in got:
        sums[r.shard] += r.size
    return [sums[i] for i in range(shards)]


def test_whole_table_is_even(spark):
    docs = documents(spark, "sf0.01")
    sums = check(docs)
    largest = docs.agg(F.max(F.octet_length("text"))).first()[0] + 1
    assert max(sums) - min(sums) <= 2 * largest


def test_odd_texts_nulls_and_clashing_names(spark):
    odd = odd_documents(spark).withColumns({c: F.lit(1) for c in ("g", "k", "row", "size", "payload", "range", "shard", "slot", "group")})
    nulls = odd.withColumn("doc_id", F.lit(None).cast("long"))
    check(odd.unionByName(nulls))


@pytest.mark.parametrize("distinct_keys", [True, False])
def test_a_group_of_a_third_of_all_rows_is_cut(spark, distinct_keys):
    key = "id" if distinct_keys else "if(id % 3 = 0, 5, id)"
    text = "if(id % 3 = 0, 'the same text again and again', concat('text ', id, repeat('x', cast(id % 50 as int))))"
    docs = spark.range(9000).selectExpr(f"{key} doc_id", f"{text} text")
    sums = check(docs)
    assert max(sums) - min(sums) <= 2 * max(80, sum(sums) // (16 * sharding.WHOLE))


def test_small_groups_stay_together(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "concat('copy of text ', id div 3) text")
    got = sharding.documents(docs).groupBy("text_crc32").agg(F.count_distinct("shard").alias("n")).where("n > 1").count()
    assert got == 0
    check(docs)


def test_overfull_ranges_are_subdivided(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, 10).otherwise(F.col("id")).alias("g"), F.col("id").alias("k"), F.lit(1).cast("long").alias("size"), F.col("id").alias("row")
    )
    cut = sharding.splitters(rows, 20_000, 64, 300)
    assert max(b for _, b in cut.totals) <= 2 * max(300, 20_000 // 64)
    assert sum(n for n, _ in cut.totals) == 20_000 and len(cut.totals) == len(cut.splitters) + 1
    assert sum(g == 10 and k != LEAST for g, k, _ in cut.splitters) > 10  # within the group, by key


def test_few_rows_more_shards_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    check(docs)
    check(docs, shards=1)
    assert sharding.documents(docs.limit(0)).collect() == []


def test_rows_of_other_kinds_and_their_files(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('k', id) name", "cast(id % 7 as int) weight", "id % 100 family", "id shard")
    placed = sharding.shards(df, key="name", size="weight", group="family", n_shards=5)
    sharding.write(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    sums = [r.s for r in back.groupBy("shard").agg(F.sum(F.greatest("row.weight", F.lit(1))).alias("s")).collect()]
    assert len(sums) == 5 and max(sums) - min(sums) <= 60
    assert back.select("row.*").exceptAll(df).count() == 0 and back.count() == 1000


def test_plan_has_no_python(spark):
    plan = sharding.documents(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
