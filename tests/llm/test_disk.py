"""What the join of near copies and the encoding leave on the shared folder and in shuffle files."""

import glob
import os
import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.helpers import odd_documents
from tripmill.llm import ngram_join as J
from tripmill.llm.blocks import shuffles_dropped
from tripmill.sources.staging import shared_dir, staged


def left(spark, before=()):
    return sorted(set(os.listdir(f"{shared_dir(spark).removeprefix('file://')}/tripmill")) - set(before))


def labels(spark, before):
    return [name.rsplit("-", 1)[0] for name in left(spark, before)]


def some_documents(spark, n=60):
    pick = random.Random(5)
    texts = []
    for _ in range(n):
        words = [f"w{pick.randrange(400)}" for _ in range(120)]
        copy = list(words)
        copy[pick.randrange(120)] = "x"
        texts += [" ".join(words), " ".join(copy)]
    return odd_documents(spark, texts)


def test_near_copies_leave_only_the_tables_of_their_result(spark):
    staged(spark.range(1), "first")  # makes the folder
    before = left(spark)
    found = J.near_copies(some_documents(spark))
    assert labels(spark, before) == ["join-names", "join-result"]
    assert found.select("component_id").distinct().count() == 60 and found.count() == 120


def test_join_keeps_what_its_result_reads(spark):
    staged(spark.range(1), "first")
    before = left(spark)
    kept = J.keep_one(some_documents(spark))
    assert labels(spark, before) == ["join-blocks", "join-classes", "join-roots"]
    assert kept.count() == 60


def test_encode_leaves_only_its_result(spark):
    staged(spark.range(1), "first")
    before = left(spark)
    done = cp.encode(spark, some_documents(spark, 5), "unused")
    assert labels(spark, before) == ["pipeline-decoded"]
    assert done.count() == 10 and done.where("n_tokens > 0").count() == 10


def shuffle_files(spark):
    folder = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()[0].getPath()
    return set(glob.glob(f"{folder}/*/shuffle_*.data"))


def test_shuffles_of_a_written_table_are_dropped(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name), shuffle_files(spark)
    with shuffles_dropped(spark):
        table = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
        for _ in range(100):
            if shuffle_files(spark) <= before:
                break
            time.sleep(0.1)
        assert shuffle_files(spark) <= before
    assert spark.conf.get(name) == setting
    assert table.count() == 7


def test_linked_sets_share_as_many_pairs_as_the_bound_asks(spark):
    pick = random.Random(11)
    for percent in (60, 80, 90, 95, 100):
        need = J._Bounds(percent)
        sizes = spark.range(1, 400).select(
            F.col("id").alias("n"), need.prefix(F.col("id")).alias("take"), need.pairs(F.col("id")).alias("pairs")
        )
        bound = {r["n"]: r for r in sizes.collect()}
        for _ in range(300):
            n = pick.randrange(1, 300)
            x = pick.sample(range(10**6), n)
            lost = pick.randrange(n * (100 - percent) // 100 + 1)
            y = x[lost:]
            while pick.random() < 0.9 and 100 * (n - lost) >= percent * (n + len(y) - (n - lost) + 1):
                y = [*y, pick.randrange(10**6, 2 * 10**6) - 10**6 * pick.randrange(2)]
            x, y = set(x), set(y)
            if not y or 100 * len(x & y) < percent * len(x | y):
                continue
            found = []
            for s in (x, y):
                first = sorted(s)[: bound[len(s)]["take"]]
                found.append(set(zip(first, first[1:])))
            shared = len(found[0] & found[1])
            assert x == y or all(shared >= bound[len(s)]["pairs"] for s in (x, y))


def test_pairs_are_of_neighbours_in_one_document():
    grams = [J.ngram_sets(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 3)[0] for t in (b"a b c d e f", b"g h i j")]
    schema = pa.schema([("block", pa.int64()), ("at", pa.int64()), ("gram", pa.int64())])
    text = b"a b c d e fg h i j"
    blocks = pa.table({
        "block": [7], "sizes": pa.array([[11, 7]], pa.list_(pa.int64())), "bytes": [len(text)],
        "text": [pa.compress(text, codec="zstd", asbytes=True)],
    })
    wanted = pa.table({"at": pa.array([0, 1]), "take": pa.array([3, 9])})
    single = J._grams(blocks, wanted, 3, schema).to_pydict()
    pairs = J._grams(blocks, wanted, 3, schema, pairs=True).to_pydict()
    assert [len(g) for g in grams] == [4, 2] and single["at"] == [0, 0, 0, 1, 1]
    assert pairs["at"] == [0, 0, 1] and len(set(pairs["gram"])) == 3
    assert all(0 <= g < 1 << 48 for g in pairs["gram"])
