import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, documents, odd_documents
from tripmill.llm import ngram_join as nj
from tripmill.llm.components import components


def shingles(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def expected(docs):
    rows = sorted((r["doc_id"], shingles(r["text"])) for r in docs.select("doc_id", "text").collect())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and 10 * min(len(a), len(b)) >= 9 * max(len(a), len(b)) and 100 * len(a & b) >= 90 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(k, len(s), rows[find(i)][0]) for i, (k, s) in enumerate(rows)]


def found(docs):
    return sorted(map(tuple, nj.near_copies(docs).collect()))


def made(seed, n=150):
    """Copies of a few texts with more and more words changed, cut or put in, and a passage
    that most have."""
    pick = random.Random(seed)
    new = lambda k: [f"w{pick.randrange(5000)}" for _ in range(k)]
    bases, passage = [new(k) for k in (5, 30, 60, 200)], new(40)
    texts = []
    for _ in range(n):
        words = list(pick.choice(bases))
        for _ in range(pick.choice([0, 0, 1, 1, 2, 3, 6])):
            i = pick.randrange(len(words) + 1)
            words[i : i + pick.choice([0, 1, 1, 4])] = new(pick.choice([0, 1, 1, 3]))
        if pick.random() < 0.5:
            words = words + passage + new(pick.choice([0, 0, 30]))
        texts.append(" ".join(words).upper() if pick.random() < 0.3 else "\n".join(words))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_made_texts(spark, seed):
    docs = odd_documents(spark, made(seed))
    want = expected(docs)
    assert found(docs) == want
    assert 10 < len({w[2] for w in want}) < len(want) - 30


def test_documents(spark):
    docs = documents(spark)
    assert found(docs) == expected(docs)


def test_odd_texts_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_BYTES", 300)
    docs = odd_documents(spark, [*ODD_TEXTS, *ODD_TEXTS, "a b", "A  B", "a b c", "b a"])
    assert found(docs) == expected(docs)
    assert found(odd_documents(spark, [])) == []


def test_null_and_repeated_keys(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "x"), (None, None)], "doc_id long, text string")
    rows = nj.near_copies(docs).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(
        map(str, [(None, 2, 3), (3, 2, 3), (3, 2, 3), (None, 1, None), (None, 0, None)])
    )


def test_keep_one(spark):
    texts = [*made(1, 60), None, "", None]
    docs = odd_documents(spark, texts)
    kept = nj.keep_one(docs)
    assert kept.columns == docs.columns
    names = {w[2] for w in expected(docs)}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r["doc_id"] in names)
    repeated = docs.where("doc_id < 2").withColumn("doc_id", F.lit(None).cast("long"))
    assert nj.keep_one(repeated.unionByName(repeated)).count() == len({w[2] for w in expected(docs.where("doc_id < 2"))})


def test_bounds():
    for n in range(1, 400):
        for m in range(n, 400):
            t = next(t for t in range(n + 1) if 100 * t >= 90 * (n + m - t)) if 100 * n >= 90 * m else None
            if t is not None:
                assert t >= np.ceil(m * 90 / 100 - 1e-9) and t >= np.ceil(n * 180 / 190 - 1e-9)


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    pick = random.Random(5)
    links = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(70, i) for i in range(60)],
        "random": [(pick.randrange(200), pick.randrange(200)) for _ in range(120)],
    }[shape]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    joined = {i for link in links if link[0] != link[1] for i in link}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((i, find(i)) for i in joined)


def test_prefixes_of_equal_sets_differ_by_the_cost_of_their_candidates(spark):
    """Rare n-grams behind the shortest prefix lengthen it, those of a common passage don't."""
    schema = "n long, own long, rare array<struct<times long, gram long>>"
    rare = [(2, i) for i in range(20)]
    common = [(2, i) for i in range(3)] + [(100_000, i) for i in range(3, 20)]
    rows = spark.createDataFrame([(20, 0, rare), (20, 0, common), (1, 0, rare[:1]), (20, 4, rare[:16])], schema)
    matches = [r[0] for r in rows.select(nj._matches(nj._Bounds(90))).collect()]
    assert matches[0] == 4 and matches[1] == 1 and matches[2] == 1  # 3 (2 + l) + 20 (2 + l) / l is least at 4
    assert matches[3] == 1  # the shortest prefix is own n-grams: no list, no cost


@pytest.mark.parametrize("most", [1, 3, 50])
def test_number_of_matches_changes_no_result(spark, monkeypatch, most):
    monkeypatch.setattr(nj, "MOST_MATCHES", most)
    docs = odd_documents(spark, made(7, 200))
    assert found(docs) == expected(docs)


def test_unlinked_documents_with_one_shared_rare_ngram(spark):
    """Many sets meet once, by chance; with more matches asked for few pairs are compared."""
    pick = random.Random(2)
    texts = [" ".join(f"u{i}x{k}" if pick.random() < 0.15 else f"c{k}" for k in range(60)) for i in range(120)]
    docs = odd_documents(spark, texts)
    assert found(docs) == expected(docs)
