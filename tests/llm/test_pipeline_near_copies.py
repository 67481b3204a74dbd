"""The stage of near copies at its own shingles and similarity, against all pairs."""

import re

import corpus_pipeline as cp
from tests.llm.helpers import documents, odd_documents

SF = "/root/testdata/sf0.001"


def shingles(text, n):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def kept(docs, n=5, percent=80):
    rows = sorted((r["doc_id"], shingles(r["text"], n)) for r in docs.select("doc_id", "text").collect())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def stage(spark, docs):
    return {r["doc_id"] for r in cp.drop_near_copies(spark, docs, SF).collect()}


def test_copy_between_the_two_thresholds_goes(spark):
    words = [f"w{i}" for i in range(100)]
    changed = words[:50] + ["x"] + words[51:]  # 0.9 on three words: (98 - 3) / (98 + 3) = 0.94
    two = changed[:20] + ["y"] + changed[21:]  # 0.885 on three words, 0.81 on five
    docs = odd_documents(spark, [" ".join(words), " ".join(two), "other words altogether"])
    assert stage(spark, docs) == kept(docs) == {0, 2}
    assert kept(docs, 3, 90) == {0, 1, 2}


def test_stage_against_all_pairs(spark):
    docs = documents(spark)
    assert stage(spark, docs) == kept(docs)
