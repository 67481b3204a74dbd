import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, odd_documents
from tripmill.llm import files, token_files
from tripmill.llm import text as T


def expected(docs):
    library = Tokenizer.from_file(token_files.TOKENIZER)
    library.encode_special_tokens = True
    out, start = [], 0
    for r in sorted(docs.select("doc_id", "text").collect()):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        out.append((r["doc_id"], start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def found(spark, docs, folder, **options):
    token_files.write(docs, folder, **options)
    return sorted(map(tuple, token_files.digests(token_files.read(spark, folder)).collect()))


@pytest.mark.parametrize("shard_bytes", [token_files.SHARD_BYTES, 10_000])
def test_odd_texts(spark, tmp_path, shard_bytes):
    docs = odd_documents(spark)
    assert found(spark, docs, f"{tmp_path}/ids", shard_bytes=shard_bytes) == expected(docs)


def test_documents(spark, tmp_path):
    docs = documents(spark)
    assert found(spark, docs, f"{tmp_path}/ids", shard_bytes=50_000) == expected(docs)


def test_every_code_point(spark, tmp_path):
    points = [chr(c) for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000]
    docs = odd_documents(spark, ["a \n".join(points[i : i + 20_000]) for i in range(0, len(points), 20_000)])
    assert found(spark, docs, f"{tmp_path}/ids") == expected(docs)


def test_few_known_words():
    words = token_files._Words(token_files.TOKENIZER, 3)
    texts = ["it's we'LL don\'\'t x2 \xb5\xb2 \xe9T\xc9 a\xa0b", "'s s' \'\'s \'\'\'ve", "İx ΣσΣ é", "<|endoftext|>y \x85z\x1c"]
    for text in texts * 2:
        split = text.encode().split()
        ids = words.ids(split, max(map(max, split)) <= 0xC3)[0].tolist()
        assert ids == words._tokenizer.encode(text, add_special_tokens=False).ids


def test_files_are_the_same_again(spark, tmp_path):
    docs = documents(spark)
    one = token_files.write(docs, f"{tmp_path}/a", shard_bytes=50_000)
    two = token_files.write(docs.repartition(5), f"{tmp_path}/b", shard_bytes=50_000)
    assert sorted(one.collect()) == sorted(two.collect())
    assert one.count() > 3


def test_empty_table(spark, tmp_path):
    assert found(spark, odd_documents(spark, []), f"{tmp_path}/ids") == []


def test_null_and_repeated_keys(spark, tmp_path):
    docs = spark.createDataFrame([(1, "b"), (None, "c"), (1, "a"), (1, "a")], "doc_id long, text string")
    token_files.write(docs, f"{tmp_path}/ids")
    rows = token_files.read(spark, f"{tmp_path}/ids").orderBy("start").collect()
    assert [r["key"] for r in rows] == [None, 1, 1, 1]
    assert [r["start"] for r in rows] == [0, 2, 4, 6]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == (1001 * bits + 7) // 8
    assert (token_files.unpack(packed, 1001, bits) == ids).all()


def test_random_access(spark, tmp_path):
    token_files.write(documents(spark), f"{tmp_path}/ids")
    with files.opened(f"file://{tmp_path}/ids", "shard-000000.ids") as f:
        tokens = token_files.TokenFile(f)
        every = tokens.ids(0, tokens.tokens)
        assert tokens.tokens > 3 * token_files.BLOCK
        for a, b in [(0, 1), (5, 5), (token_files.BLOCK - 1, token_files.BLOCK + 1), (70_000, 90_001)]:
            assert (tokens.ids(a, b) == every[a:b]).all()


def test_a_broken_write_leaves_no_file(tmp_path):
    with pytest.raises(RuntimeError), files.committed(f"file://{tmp_path}", "x") as out:
        out.write(b"half")
        raise RuntimeError
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == []


def test_words_that_share_a_hash(monkeypatch):
    data = np.frombuffer(b"one two one three two", np.uint8)
    starts, ends, _ = T.words(data, np.array([0, len(data)]))
    for collide in (False, True):
        if collide:
            monkeypatch.setattr(T, "word_hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
        distinct, number = T.distinct_words(data, starts, ends)
        assert [distinct[i] for i in number] == data.tobytes().split() and len(distinct) == 3


def test_known_words_are_found_again_in_any_piece():
    """The table of known words against a dictionary, over many small pieces."""
    rng = np.random.default_rng(5)
    known, plain = token_files._Known(), {}
    for _ in range(60):
        one = np.unique(rng.integers(0, 50_000, 3000).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        two = one ^ np.uint64(12345)
        start, _ = known.find(one, two)
        assert [s >= 0 for s in start] == [int(x) in plain for x in one]
        new = np.flatnonzero(start < 0)
        count = (one[new] % np.uint64(5)).astype(np.int64)
        flat = rng.integers(0, 49_000, int(count.sum())).astype(np.uint32)
        known.add(one[new], two[new], flat, count)
        ends = np.cumsum(count)
        plain.update((int(x), flat[e - c : e].tolist()) for x, c, e in zip(one[new], count, ends))
        start, count = known.find(one, two)
        assert known.ids(start, count).tolist() == [i for x in one for i in plain[int(x)]]
    assert (known.find(one, one)[0] < 0).all()  # the other hash has to agree as well


def test_few_known_words_change_nothing(spark, monkeypatch):
    words = token_files._Words(token_files.TOKENIZER, 10)
    texts = ["one two three four five six seven eight nine ten eleven twelve", "twelve one thirteen caf\xe9 \u0416 one", ""] * 4
    library = words._tokenizer
    for text in texts:
        data, offsets = T.raw(pa.array([text]))
        starts, ends, _ = T.words(data, offsets)
        hashes, some, number = T.distinct_spans(data, starts, ends)
        flat, length = words.of(data, hashes, starts[some], ends[some], False)
        first = np.cumsum(length) - length
        assert T.gather(flat, first[number], length[number]).tolist() == library.encode(text, add_special_tokens=False).ids
