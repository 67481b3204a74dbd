"""Byte-level BPE: every distinct word is encoded once, for the whole corpus.

1. Each task cuts its texts into words (matches of the pattern) and numbers the distinct
   words of a block of texts; a text becomes the list of its words' numbers, which keeps
   their positions. The lists are written bucketed by block and never move again.
2. The distinct words of all blocks are shuffled by their hash, so that each is merged
   into ids once, and the ids return to their blocks. A row carries the words that one
   block has in one part of the hash range, compressed.
3. Each block's ids and its texts' numbers meet and give the ids of whole texts.

A word that occurs everywhere costs one entry per block. The only state of a task is one
block, which has a bounded number of words and distinct words. Decoding looks every id up
in the table of token bytes, which is as small as the vocabulary and is sent to all tasks.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tripmill.llm import text as T
from tripmill.llm.blocks import bucketed, buckets

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: A block of texts ends after so many distinct words, or so many words.
BLOCK_DISTINCT, BLOCK_WORDS = 1 << 18, 1 << 22
#: Words of consecutive texts that are compressed together.
GROUP_WORDS = 1 << 16
#: Distinct words whose ids a task remembers.
KNOWN_WORDS = 1 << 19
#: Texts below this code point are cut by the faster of two engines.
NARROW = 0x250


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one token per line, in base64, and its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Splitter:
    """All matches of the pattern, as tiktoken finds them.

    The two regular expression engines follow different versions of Unicode. Where they
    disagree on letters and digits is found out once per process, by asking tiktoken; a
    text with such a character is cut by a pattern without those code points.
    """

    def __init__(self, pattern: str):
        import regex

        odd = {name: self._ranges(self._disagreement(name)) for name in (r"\p{L}", r"\p{N}")}
        self._odd = regex.compile(f"[{''.join(odd.values())}]").search if any(odd.values()) else None
        exact = pattern.replace(r"[^\s\p{L}\p{N}]", "\0")  # a class is put into a class without its brackets
        for name, points in odd.items():
            exact = exact.replace(name, rf"[{name}--[{points}]]" if points else name)
        inner = "".join(rf"[{name}--[{points}]]" if points else name for name, points in odd.items())
        exact = exact.replace("\0", rf"[^\s{inner}]")
        self._plain = regex.compile(pattern).findall
        self._exact = regex.compile(exact, regex.V1).findall
        low = "".join(map(chr, range(NARROW)))
        sets = {name: self._ranges(sorted(map(ord, regex.findall(name, low)))) for name in (r"\s", r"\p{L}", r"\p{N}")}
        narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{''.join(sets.values())}]").replace(r"\S", f"[^{sets[chr(92) + 's']}]")
        for name, points in sets.items():
            narrow = narrow.replace(name, f"[{points}]")
        known = not re.search(r"\\[^UpsS]|\\p\{(?![LN]\})", pattern)
        self._narrow = re.compile(narrow).findall if known else self._plain

    @staticmethod
    def _disagreement(category: str) -> list[int]:
        import regex
        import tiktoken

        single = {bytes([b]): b for b in range(256)}
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        theirs = tiktoken.Encoding("class", pat_str=category, mergeable_ranks=single, special_tokens={})
        found = set(bytes(theirs.encode_ordinary(every)).decode())
        ours = set(regex.findall(category, every))
        if found - ours:
            raise ValueError(f"{category}: code points are missing here that the tokenizer knows")
        return sorted(map(ord, ours - found))

    @staticmethod
    def _ranges(points: list[int]) -> str:
        if not points:
            return ""
        p = np.array(points)
        cut = np.flatnonzero(np.diff(p) > 1)
        return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(p[np.r_[0, cut + 1]], p[np.r_[cut, len(p) - 1]]))

    def __call__(self, text: str, narrow: bool = False) -> list[str]:
        """``narrow`` promises that all characters are below ``NARROW``."""
        if narrow:
            return self._narrow(text)
        if self._odd and self._odd(text):
            return self._exact(text)
        return self._plain(text)


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


_cache: dict = {}


def _splitter(pattern: str) -> Splitter:
    if ("split", pattern) not in _cache:
        _cache["split", pattern] = Splitter(pattern)
    return _cache["split", pattern]


def _pack(numbers: np.ndarray) -> bytes:
    """Zstandard over the bytes of equal weight, which are alike."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4").ravel()


#: Rows of a block: its texts (keys, counts of words, numbers of words), or the words it
#: has in one part of the hash range (as UTF-8, each with its length, and their numbers).
def _block_schema(kind) -> S.StructType:
    return S.StructType([
        S.StructField("block", S.LongType()), S.StructField("part", S.IntegerType()), S.StructField("n", S.LongType()),
        S.StructField("bytes", S.LongType()), S.StructField("words", S.BinaryType()), S.StructField("lengths", S.BinaryType()),
        S.StructField("numbers", S.BinaryType()), S.StructField("keys", S.ArrayType(kind)),
        S.StructField("counts", S.ArrayType(S.IntegerType())),
    ])


def _row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


def _blocks(batches, pattern: str, parts: int, distinct: int, words: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    split = _splitter(pattern)
    block = TaskContext.get().partitionId() << 32
    numbers, keys, counts, lists = _Numbers(), [], [], []
    held = total = 0

    def group() -> pa.RecordBatch:
        nonlocal keys, counts, lists, held
        row = _row(schema, block=block, n=held, numbers=_pack(np.concatenate(lists)), keys=keys, counts=counts)
        keys, counts, lists, held = [], [], [], 0
        return row

    def dictionary() -> Iterator[pa.RecordBatch]:
        """Rows for each part of the hash range; words stay in order of their numbers."""
        nonlocal numbers, block, total
        found = [w.encode() for w in numbers]
        part = np.fromiter(map(zlib.crc32, found), np.uint32, len(found)) % parts
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)):
            chosen = order[cuts[p] : cuts[p + 1]]
            some = [found[i] for i in chosen]
            joined = b"".join(some)
            lengths = np.fromiter(map(len, some), np.uint32, len(some))
            yield _row(
                schema, block=block, part=int(p), n=len(some), bytes=len(joined), lengths=_pack(lengths),
                words=pa.compress(joined, codec="zstd", asbytes=True), numbers=_pack(np.diff(chosen, prepend=0)),
            )
        numbers, block, total = _Numbers(), block + 1, 0

    for batch in batches:
        for piece in T.pieces(batch, "text"):
            data, offsets = T.raw(piece.column("text"))
            for key, a, b in zip(piece.column("key").to_pylist(), offsets[:-1], offsets[1:]):
                one = data[a:b]
                # bytes above 0xC8 begin characters from U+0240 on
                found = split(one.tobytes().decode(), len(one) == 0 or one.max() <= 0xC8)
                keys.append(key)
                counts.append(len(found))
                lists.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                held, total = held + len(found), total + len(found)
                full = len(numbers) >= distinct or total >= words
                if full or held >= GROUP_WORDS or len(keys) >= GROUP_WORDS:
                    yield group()
                if full:
                    yield from dictionary()
    if keys:
        yield group()
    yield from dictionary()
    T.release()


class _Merged(dict):
    def __init__(self, encode):
        self._encode = encode

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        ids = self[word] = self._encode(word.decode())
        return ids


def digest(ranks: dict[bytes, int]) -> str:
    """Name of a rank table by its contents, by which Python processes keep what they make of it."""
    h = hashlib.sha256()
    for token, number in sorted(ranks.items()):
        h.update(b"%d:%d:%b" % (number, len(token), token))
    return h.hexdigest()


def _kept(kind: str, name: tuple, make):
    """What ``make`` gives, kept until another of this kind is asked for."""
    if _cache.get(kind, (None,))[0] != name:
        _cache[kind] = name, make()
    return _cache[kind][1]


def _merge(batches, ranks, name: str, pattern: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    import tiktoken

    make = lambda: tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
    known = _Merged(_kept("encoding", (name, pattern), make).encode_ordinary).__getitem__
    for batch in batches:
        for row in batch.to_pylist():
            data = pa.decompress(row["words"], decompressed_size=row["bytes"], codec="zstd", asbytes=True)
            ends = np.cumsum(_unpack(row["lengths"], row["n"])).tolist()
            ids = [known(data[a:b]) for a, b in zip([0, *ends], ends)]
            lengths = np.fromiter(map(len, ids), np.uint32, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            yield _row(schema, block=row["block"], n=row["n"], lengths=_pack(lengths), numbers=row["numbers"], ids=_pack(flat))
    del known  # the memory of a task ends with it
    T.release()


def _assemble(merged: pa.Table, texts: pa.Table, schema: pa.Schema) -> pa.Table:
    """Ids of the texts of one block."""
    starts = np.zeros(sum(merged.column("n").to_pylist()), np.int64)
    lengths = np.zeros_like(starts)
    flat, done = [np.zeros(0, np.uint32)], 0
    for row in merged.to_pylist():
        size = _unpack(row["lengths"], row["n"]).astype(np.int64)
        numbers = np.cumsum(_unpack(row["numbers"], row["n"]))
        lengths[numbers] = size
        starts[numbers] = done + np.cumsum(size) - size
        done += int(size.sum())
        flat.append(_unpack(row["ids"], int(size.sum())))
    values = np.concatenate(flat).astype(np.int32)
    out = []
    for row in texts.to_pylist():
        numbers = _unpack(row["numbers"], row["n"])
        size = lengths[numbers]
        ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(row["counts"], dtype=np.int64)]]
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(T.gather(values, starts[numbers], size)))
        out.append(pa.RecordBatch.from_arrays([pa.array(row["keys"], schema.field(0).type), ids], schema=schema))
    del flat, values
    T.release()
    return pa.Table.from_batches(out, schema=schema)


def _arrow(schema: S.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def encode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ranks_path: str = RANKS,
    pattern: str = PATTERN,
    block_distinct: int = BLOCK_DISTINCT,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Rows (key, ids array<int>): the ids of every text.

    Null and empty texts have no ids. Every row gives a row, repeated and null keys
    included; other columns are ignored, whatever their names. An empty table gives an
    empty table. The blocks are written to the shared folder when this is called.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType
    parts = buckets(docs)
    blocks = _block_schema(kind)
    block_schema = _arrow(blocks)
    cut = bucketed(
        source.mapInArrow(lambda it: _blocks(it, pattern, parts, block_distinct, block_words, block_schema), blocks),
        "block", "bpe-blocks",
    )

    table = read_ranks(ranks_path)
    ranks, name = spark.sparkContext.broadcast(table), digest(table)  # as large as the vocabulary
    merged = S.StructType([
        S.StructField("block", S.LongType()), S.StructField("n", S.LongType()), S.StructField("lengths", S.BinaryType()),
        S.StructField("numbers", S.BinaryType()), S.StructField("ids", S.BinaryType()),
    ])
    merged_schema = _arrow(merged)
    ids = (
        cut.where(F.col("part").isNotNull())
        .select("block", "part", "n", "bytes", "words", "lengths", "numbers")
        .repartitionById(parts, "part")
        .mapInArrow(lambda it: _merge(it, ranks, name, pattern, merged_schema), merged)
    )
    texts = cut.where(F.col("part").isNull()).select("block", "n", "numbers", "keys", "counts")
    out = S.StructType([S.StructField("key", kind), S.StructField("ids", S.ArrayType(S.IntegerType()))])
    out_schema = _arrow(out)
    together = ids.groupBy("block").cogroup(texts.groupBy("block"))
    return together.applyInArrow(lambda a, b: _assemble(a, b, out_schema), out).withColumnRenamed("key", key)


def _decode(batches, ranks, name: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def by_number() -> pa.Array:
        table = [None] * (max(ranks.value.values()) + 1)
        for token, number in ranks.value.items():
            table[number] = token
        return pa.array(table, pa.large_binary())

    table = _kept("bytes", (name,), by_number)
    for batch in batches:
        ids = batch.column(1)
        flat = ids.flatten()
        known = np.r_[0, np.cumsum(ids.value_lengths().fill_null(0).to_numpy())]
        numbers = flat.to_numpy(zero_copy_only=False)
        if len(numbers) and not 0 <= numbers.min() <= numbers.max() < len(table):
            raise ValueError("an id is not in the token table")
        tokens = table.take(flat)
        _, at, data = tokens.buffers()
        at = np.frombuffer(at, np.int64)[tokens.offset : tokens.offset + len(tokens) + 1] if len(tokens) else np.zeros(1, np.int64)
        joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(at[known].copy()), data])
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, joined.cast(pa.binary())], schema=schema)
        del tokens, data, joined
        T.release()


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", ranks_path: str = RANKS) -> DataFrame:
    """Rows (key, ids, bytes): the bytes of each list of ids, joined with the token table.

    No ids and a null list give no bytes. An id outside the table is an error."""
    spark = encoded.sparkSession
    table = read_ranks(ranks_path)
    ranks, name = spark.sparkContext.broadcast(table), digest(table)
    source = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    out = S.StructType([*source.schema.fields, S.StructField("bytes", S.BinaryType())])
    schema = _arrow(out)
    return source.mapInArrow(lambda it: _decode(it, ranks, name, schema), out).withColumnRenamed("key", key)


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows (key, n_tokens, ids_sha256, decoded_sha256) of decoded texts."""
    return decoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )
