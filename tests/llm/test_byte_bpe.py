import hashlib

import pytest
import tiktoken

from tests.llm.helpers import documents, odd_documents
from tripmill.llm import byte_bpe


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "ranks", pat_str=byte_bpe.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.RANKS), special_tokens={}
    )


def expected(docs, library):
    out = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        out[r["doc_id"]] = (
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode_bytes(ids)).hexdigest(),
        )
    return out


def found(docs, **options):
    frame = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs, **options)))
    return {r["doc_id"]: tuple(r)[1:] for r in frame.collect()}


@pytest.mark.parametrize("limits", [{}, {"block_words": 5}, {"block_distinct": 7}])
def test_odd_texts(spark, library, limits):
    docs = odd_documents(spark)
    assert found(docs, **limits) == expected(docs, library)


def test_blocks_stay_where_they_are(spark):
    plan = byte_bpe.encode(documents(spark))._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_documents(spark, library):
    docs = documents(spark)
    assert found(docs) == expected(docs, library)


def test_every_code_point(spark, library):
    points = [chr(c) for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000]
    docs = odd_documents(spark, ["a1 ".join(points[i : i + 5000]) for i in range(0, len(points), 5000)])
    assert found(docs) == expected(docs, library)


def test_repeated_and_null_keys(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (1, None)], "doc_id long, text string")
    rows = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert sorted((str(r[0]), bytes(r["bytes"])) for r in rows) == [("1", b""), ("1", b"a b"), ("1", b"a b"), ("None", b"a b")]


def test_empty_table(spark):
    assert found(odd_documents(spark, [])) == {}


def test_unknown_id(spark):
    with pytest.raises(Exception, match="not in the token table"):
        byte_bpe.decode(spark.createDataFrame([(1, [99_999_999])], "doc_id long, ids array<int>")).collect()


def test_two_rank_files_in_one_session(spark, tmp_path):
    """What Python processes keep goes by the contents of a rank file and the pattern."""
    import base64

    table = byte_bpe.read_ranks(byte_bpe.RANKS)
    other = {token: (number + 7) % len(table) for token, number in table.items()}
    path = tmp_path / "other.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % n for t, n in sorted(other.items(), key=lambda x: x[1])))
    docs = odd_documents(spark, ["some words, q and \xf3", "more words"])
    for ranks_path in (byte_bpe.RANKS, str(path), byte_bpe.RANKS):
        ranks = byte_bpe.read_ranks(ranks_path)
        by_number = {n: t for t, n in ranks.items()}
        done = byte_bpe.decode(byte_bpe.encode(docs, ranks_path=ranks_path), ranks_path=ranks_path)
        for row in done.join(docs, "doc_id").select("ids", "bytes", docs["text"]).collect():
            assert b"".join(by_number[i] for i in row["ids"]) == bytes(row["bytes"]) == row["text"].encode()
