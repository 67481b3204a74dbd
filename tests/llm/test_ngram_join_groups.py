"""Long lists of the n-gram join: close members are told by how they differ from the middle."""

import random

import pytest

from tests.llm.helpers import odd_documents
from tests.llm.test_ngram_join import made
from tests.llm.test_pipeline_near_copies import kept
from tripmill.llm import ngram_join as nj


def variants(seed, n, length=150, new=0.8):
    """Copies of one text, each with up to four of its words changed, most to new ones."""
    pick = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    texts = []
    for copy in range(n):
        words = list(base)
        for i in pick.sample(range(length), pick.choice([1, 1, 2, 3, 3, 4])):
            words[i] = f"c{copy}-{i}" if pick.random() < new else f"c{i}"
        texts.append(" ".join(words))
    return texts


def left(docs, percent):
    return {r["doc_id"] for r in nj.keep_one(docs, words=5, percent=percent).collect()}


@pytest.mark.parametrize("percent", [80, 55])
def test_all_lists_by_diffs_against_all_pairs(spark, monkeypatch, percent):
    monkeypatch.setattr(nj, "LONG_LIST", 1)
    docs = odd_documents(spark, made(11, 120) + variants(12, 60))
    assert left(docs, percent) == kept(docs, 5, percent)


def test_chain_away_from_the_middle(spark, monkeypatch):
    """Each differs from the next by a word more: linked to its neighbours alone."""
    monkeypatch.setattr(nj, "LONG_LIST", 1)
    words = [f"w{i}" for i in range(100)]
    chain = [" ".join([f"x{i}" if i % 12 == 5 and i < 12 * k else w for i, w in enumerate(words)]) for k in range(9)]
    docs = odd_documents(spark, chain)
    assert left(docs, 90) == kept(docs, 5, 90)


def test_pairs_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    rows = {}
    written = nj.staged

    def seen(df, label, *options):
        out = written(df, label, *options)
        rows[label] = out.count()
        return out

    monkeypatch.setattr(nj, "staged", seen)
    docs = odd_documents(spark, variants(3, 300, new=1.0))
    assert left(docs, 80) == kept(docs)
    assert rows["join-pairs"] <= 600
