"""Merkle manifest against trees that are built in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, documents, odd_documents
from tripmill.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(digests: list[str]) -> list[list[str]]:
    found = [digests]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + 16])) for i in range(0, len(found[-1]), 16)])
    return found


def path(tree, i: int) -> list[tuple[str, str]]:
    steps = []
    for level in tree[:-1]:
        begin = i - i % 16
        steps.append(("".join(level[begin:i]), "".join(level[i + 1 : begin + 16])))
        i //= 16
    return steps


def expected(rows) -> list[tuple]:
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {name: levels([leaf(r) for r in groups[name]]) for name in names}
    over = levels([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            steps = path(trees[name], i) + path(over, k)
            changed = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            folded = leaf(changed)
            for left, right in steps:
                folded = sha(left + folded + right)
            root = over[-1][0]
            proof = sha("".join(a + b for a, b in steps))
            out.append((row[0], leaf(row), trees[name][-1][0], root, proof, folded, folded == root, i))
    return out


def check(df):
    got = merkle.verified(df).collect()
    want = expected([tuple(r) for r in df.select(*merkle.COLUMNS).collect()])
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    return got


def test_whole_table(spark):
    got = check(documents(spark))
    assert {r.verified for r in got} == {True, False}


def test_odd_rows_nulls_ties_and_repeats(spark):
    rows = [(i, s, "en", len(t or ""), t) for i, t in enumerate(ODD_TEXTS) for s in ("b", None, "", "é", "=")]
    rows += [(None, "b", None, None, None), (None, "b", None, None, "X"), (None, None, None, None, None)]
    rows += [(3, "b", "en", 4, "Once"), (3, "b", "en", 4, "Twice")]  # one key, other leaves
    rows += [(5, "r", "en", 3, "Abc")] * 40  # rows that agree in everything
    check(spark.createDataFrame(rows, SCHEMA).repartition(5))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257])
def test_sizes_of_runs(spark, n):
    check(spark.createDataFrame([(i, "one", None, None, f"T{i}") for i in range(n)], SCHEMA))


def test_many_groups_need_levels_of_their_own(spark):
    check(spark.range(600).selectExpr("id doc_id", "concat('s', id % 300) source", "'' lang", "id n_chars", "concat('Text ', id) text"))


def test_empty_table(spark):
    got = merkle.verified(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[:4] == ["doc_id", "leaf", "subroot", "root"]


def test_other_columns_do_not_matter(spark):
    names = ("grp", "key", "lo", "hi", "n", "digest", "run", "up", "row", "also", "slice", "place", "bucket", "root")
    docs = documents(spark)
    plain = {tuple(r) for r in merkle.verified(docs).collect()}
    assert {tuple(r) for r in merkle.verified(docs.withColumns({c: F.lit(7) for c in names})).collect()} == plain


def test_key_group_columns_and_fan_out_are_the_callers(spark):
    df = odd_documents(spark)
    rows = merkle.manifest(df, key="doc_id", group="lang", columns=("text", "block"), fan_out=3)
    found = rows.select("doc_id", "lo", "hi", F.size("up").alias("steps"), (merkle.fold(F.col("leaf"), F.col("up")) == F.col("root")).alias("ok")).collect()
    assert len(found) == df.count() and all(r.ok and r.hi == r.lo + 1 and r.steps == 3 for r in found)


def test_a_change_is_seen_only_in_its_own_proof(spark):
    docs = documents(spark).limit(0).unionByName(documents(spark))
    before = merkle.manifest(docs).select("doc_id", "leaf", "root").collect()
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 7, F.lit("other")).otherwise(F.col("text")))
    after = {r.doc_id: r for r in merkle.manifest(changed).select("doc_id", "leaf", "root").collect()}
    assert [r.doc_id for r in before if after[r.doc_id].leaf != r.leaf] == [7]
    assert {r.root for r in before}.isdisjoint({r.root for r in after.values()})
