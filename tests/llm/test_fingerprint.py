import hashlib
import random

import pytest

from tests.llm.helpers import documents, odd_documents
from tripmill.llm import fingerprint as fp


def expected(docs):
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        new = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        a, b, c = (slow(t) for t in (text, new, after))
        out.append((key, len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return out


def slow(text):
    """The fingerprint byte by byte."""
    data = text.encode()
    base, mask = 0x5851F42D4C957F2D, (1 << 64) - 1

    def total(run):
        return sum(int(fp._BYTE[b]) * pow(base, i, 1 << 64) for i, b in enumerate(run)) & mask

    rolled = [total(bytes(max(0, 7 - i)) + data[max(0, i - 7) : i]) for i in range(1, len(data) + 1)]

    def pieces(bits):
        cuts = [i for i, r in enumerate(rolled, 1) if r & ((1 << bits) - 1) == 0]
        return cuts, sorted({*cuts, len(data)} - {0})

    bits = fp.SMALLEST_BLOCK_BITS
    while len(pieces(bits)[0]) >= fp.PIECES:
        bits += 1

    def symbols(bits):
        out, start = "", 0
        for stop in pieces(bits)[1]:
            import numpy as np

            n = total(data[start:stop]) ^ ((stop - start) * 0xC2B2AE3D27D4EB4F & mask)
            out += fp._SYMBOLS[int(fp.T.mix(np.array([n], np.uint64))[0] >> np.uint64(52))]
            start = stop
        return out

    return f"{1 << bits}:{symbols(bits)}:{symbols(bits + 1)}"


def test_against_bytewise():
    words = random.Random(1)
    texts = ["", "a", "abcdefg", "é日本" * 9, "the cat " * 40, "".join(words.choice("abcdef \n") for _ in range(3000)), "x" * 300]
    assert fp.fingerprints([t.encode() for t in texts]) == list(map(slow, texts))


def found(docs, **options):
    return sorted(map(tuple, fp.compare_with_next(docs, **options).collect()))


@pytest.mark.parametrize("shard_bytes", [fp.SHARD_BYTES, 5_000])
def test_odd_texts(spark, shard_bytes):
    texts = [t for t in odd_documents(spark).sort("doc_id").select("text").toPandas()["text"]]
    texts = [t[:600] if t else t for t in texts]
    docs = odd_documents(spark, texts)
    assert found(docs, shard_bytes=shard_bytes) == expected(docs)


def test_documents(spark):
    docs = documents(spark).where("n_chars < 1500")
    rows = found(docs, shard_bytes=20_000)
    assert rows == expected(docs)
    assert sum(r[5] > 0.5 for r in rows) > 0.9 * len(rows)
    assert sum(r[6] > 0.5 for r in rows) < 0.1 * len(rows)


def test_one_document_empty_table_null_keys(spark):
    schema = "doc_id long, text string"
    (row,) = found(spark.createDataFrame([(4, "abcdefgh")], schema))
    assert row[1:3] == (8, hashlib.sha256(b"abcdefab").hexdigest()) and row[6] == 1.0
    assert found(spark.createDataFrame([], schema)) == []
    rows = fp.compare_with_next(spark.createDataFrame([(None, "b"), (None, None), (1, "b"), (1, "b")], schema)).collect()
    assert sorted((str(r["doc_id"]), r["near_next"]) for r in rows) == [("1", 0.0), ("1", 1.0), ("None", 0.0), ("None", 1.0)]


def test_likeness():
    assert fp.likeness("4::", "4::") == 1.0
    assert fp.likeness("4::", "4:AA:AA") == 0.0
    assert fp.likeness("8:AABB:CC", "4:DDEE:AABB") == 1.0
    assert fp.likeness("8:AABB:CC", "32:AABB:CC") == 0.0
    assert fp.likeness("8:AABBCC:XX", "8:AACC:YY") == pytest.approx(0.8)
    a, b = (list(random.Random(s).choices("abcd", k=40)) for s in (1, 2))
    table = [[0] * 41 for _ in range(41)]
    for i in range(40):
        for j in range(40):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    assert fp._common(a, b) == table[40][40]


def test_a_small_edit_keeps_most_symbols():
    words = [f"word{random.Random(i).randrange(9999)}" for i in range(3000)]
    before = " ".join(words)
    words[1500] = "other"
    a, b = fp.fingerprints([before.encode(), " ".join(words).encode()])
    assert 0.9 < fp.likeness(a, b) < 1
