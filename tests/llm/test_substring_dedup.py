import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import ODD_TEXTS, documents, odd_documents
from tripmill.llm import substring_dedup as sd


def expected(texts):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    n = sd.WINDOW
    seen = Counter(tuple(w[i : i + n]) for w in lists for i in range(len(w) - n + 1))
    out = []
    for w in lists:
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        out.append((" ".join(x for j, x in enumerate(w) if j not in gone), len(w), len(gone)))
    return out


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), *e) for r, e in zip(rows, expected([r["text"] for r in rows])))
    got = sorted((str(r["row"]["doc_id"]), r["text"], r["n_words"], r["n_removed"]) for r in sd.cut(docs).collect())
    assert got == want
    return sum(w[3] for w in want)


def test_documents(spark):
    assert check(documents(spark)) > 1000


def made(seed):
    """Texts of passages that overlap, are cut short, repeat within a text or differ by a word."""
    pick = random.Random(seed)
    passages = [[f"w{pick.randrange(400)}" for _ in range(pick.choice([20, 34, 35, 36, 60, 90]))] for _ in range(8)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(pick.randrange(5)):
            p = list(pick.choice(passages))
            a, b = sorted((pick.randrange(len(p)), pick.randrange(len(p) + 1)))
            p = pick.choice([p, p[a:], p[:b], p[a:b]])
            if p and pick.random() < 0.3:
                p[pick.randrange(len(p))] = "new"
            words += p + [f"u{pick.randrange(10**6)}" for _ in range(pick.choice([0, 0, 1, 40]))]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_made_texts(spark, seed):
    assert check(odd_documents(spark, made(seed))) > 100


def test_one_word_over_and_over(spark):
    texts = ["la " * n for n in (0, 1, 34, 35, 36, 100)] + ["la lo " * 30, "lo la " * 30, "a b c d e f g h i j k l m " * 9]
    check(odd_documents(spark, texts))


def test_odd_texts(spark):
    check(odd_documents(spark, [*ODD_TEXTS, *ODD_TEXTS]))
    assert sd.cut(odd_documents(spark, [])).collect() == []


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK_BYTES", 500)
    check(odd_documents(spark, made(7)))


def test_nulls_and_columns(spark):
    text = " ".join(map(str, range(40)))
    docs = spark.createDataFrame(
        [(None, text, "b"), (None, text, None), (1, text + " x", "r")], "doc_id long, text string, block string"
    )
    out = sd.remove(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(
        map(str, spark.createDataFrame([(None, "", "b"), (None, "", None), (1, "x", "r")], docs.schema).collect())
    )
    assert [r["text"] for r in sd.remove(docs.select("text")).collect()].count("") == 2
