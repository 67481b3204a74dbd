"""Token ids in files of fixed-width bits.

Every id takes as many bits as the largest id of the vocabulary needs. Ids are packed in
blocks of ``BLOCK`` ids; the footer has the offset of each block and the first id of each
document, so any run of ids is read with one seek and unpacked by numpy.

    head    magic, bits (u4), ids per block (u4)
    blocks  packed ids, lowest bit first; the last block is as long as it must be
    foot    block offsets (u8, one more than blocks), document ids (i8), null flags (u1),
            first id of each document and the end of the last (u8)
    tail    blocks, documents, ids (u8 each), magic

A shard is a range of document ids and one file; where shards begin depends on the ids
alone. The manifest lists the files and their counts; running totals over it give the
place of every document among all ids.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tripmill.llm import files
from tripmill.llm import text as T

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
MAGIC = b"TMIDS001"
BLOCK = 1 << 14
#: Bytes of text per file, about.
SHARD_BYTES = 1 << 25
#: Words and parts of words whose ids a task remembers.
KNOWN_WORDS, KNOWN_PARTS = 500_000, 150_000
#: How the tokenizer file cuts text, and the same for lower-case text of code points below
#: U+0100, where the letters and digits are these.
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_L, _N, _S = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN_PARTS = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+"

ENCODED = S.StructType([S.StructField("shard", S.IntegerType()), S.StructField("key", S.LongType()),
                        S.StructField("n", S.LongType()), S.StructField("packed", S.BinaryType())])
MANIFEST = S.StructType([S.StructField("shard", S.IntegerType()), S.StructField("file", S.StringType()),
                         S.StructField("documents", S.LongType()), S.StructField("tokens", S.LongType()),
                         S.StructField("bytes", S.LongType()), S.StructField("crc32", S.LongType())])
READ = S.StructType([S.StructField("key", S.LongType()), S.StructField("start", S.LongType()),
                     S.StructField("ids", S.ArrayType(S.IntegerType())), S.StructField("crc32", S.LongType())])


def pack(ids: np.ndarray, bits: int) -> bytes:
    ids = ids.astype("<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    lines = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(lines, bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    lines = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = lines
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class _Known:
    """Ids of words by two hashes of them, in arrays: some 40 bytes a word."""

    def __init__(self):
        self._flat, self._used, self.words = np.zeros(1 << 16, np.uint32), 0, 0
        none = np.zeros(0, np.uint64)
        # rows (hash, other hash, first id, count) in order of the hash, the larger table first
        self._tables = [(none, none, np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]

    def find(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id (-1: unknown) and count of each word."""
        start, count = np.full(len(one), -1, np.int64), np.zeros(len(one), np.int64)
        for a, b, starts, counts in self._tables:
            if len(a):
                at = np.minimum(np.searchsorted(a, one), len(a) - 1)
                hit = (a[at] == one) & (b[at] == two)
                start[hit], count[hit] = starts[at[hit]], counts[at[hit]]
        return start, count

    def add(self, one: np.ndarray, two: np.ndarray, flat: np.ndarray, count: np.ndarray) -> None:
        while self._used + len(flat) > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        self._flat[self._used : self._used + len(flat)] = flat
        rows = one, two, self._used + np.cumsum(count) - count, count
        self._used, self.words = self._used + len(flat), self.words + len(one)
        large, small = self._tables
        small = self._merged(small, rows)
        if len(small[0]) > 1 << 15:
            large, small = self._merged(large, small), tuple(x[:0] for x in small)
        self._tables = [large, small]

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        both = [np.concatenate(pair) for pair in zip(a, b)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)

    def ids(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        return T.gather(self._flat, start, count)


class _Words:
    """Ids of words. The tokenizer drops white space and never merges across it, so a
    text's ids are those of its words.

    Words of Latin letters are cut as the tokenizer would cut them; parts not seen before
    go through its model together: only the last id of a part ends a word, which tells the
    parts' ids apart. All other words go through the whole tokenizer one by one.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        settings = json.loads(self._tokenizer.to_str())
        self._limit, self._parts = limit, {}
        # words met lately and those met before them; a word that is met again stays
        self._known, self._before = _Known(), _Known()
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = settings["model"].get("end_of_word_suffix")
        self._ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        known = suffix and LATIN_PATTERN in self._patterns(settings)
        self._cut = re.compile(LATIN_PARTS + "|\n").findall if known else None
        # the same model for parts that are cut, in lower case and spelt in its alphabet
        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        self._model.normalizer = normalizers.Sequence([])
        self._model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._spell = lambda part: part if part.isascii() and part.isprintable() else spell.pre_tokenize_str(part)[0][0]

    @staticmethod
    def _patterns(settings: dict) -> list[str]:
        steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return [s["pattern"].get("Regex") for s in steps if s["type"] == "Split"]

    def _alone(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, parts: list[str]) -> None:
        lines = [" ".join(map(self._spell, parts[i : i + 1000])) for i in range(0, len(parts), 1000)]
        found = self._model.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in found), np.uint32)
        stops = np.flatnonzero(self._ends[ids]) + 1
        if len(stops) != len(parts) or stops[-1] != len(ids):
            self._parts.update((p, self._alone(p)) for p in parts)
            return
        data, stops = ids.astype("<u4").tobytes(), (4 * stops).tolist()
        self._parts.update((p, data[a:b]) for p, a, b in zip(parts, [0, *stops], stops))

    def _latin(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._parts) > KNOWN_PARTS:
            self._parts.clear()
        self._parts["\n"] = b""  # stands between words
        parts = self._cut(b"\n".join(words).decode().lower())
        found = list(map(self._parts.get, parts))
        missing = {p for p, ids in zip(parts, found) if ids is None}
        if missing:
            self._learn(list(missing))
            found = list(map(self._parts.__getitem__, parts))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        between = np.fromiter(map("\n".__eq__, parts), bool, len(parts))
        return np.frombuffer(b"".join(found), "<u4"), np.diff(np.r_[0, ends[between], ends[-1]]) // 4

    def ids(self, words: list[bytes], latin: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has. ``latin`` promises
        that all characters are below U+0100."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if latin and self._cut:
            return self._latin(words)
        # bytes above 0xC3 begin characters from U+0100 on
        other = [i for i, w in enumerate(words) if not self._cut or max(w) > 0xC3]
        lists: list = [None] * len(words)
        for i in other:
            lists[i] = self._alone(words[i].decode())
        rest = [i for i, ids in enumerate(lists) if ids is None]
        if rest:
            flat, length = self._latin([words[i] for i in rest])
            data, stops = flat.tobytes(), (4 * np.cumsum(length)).tolist()
            for i, a, b in zip(rest, [0, *stops], stops):
                lists[i] = data[a:b]
        return np.frombuffer(b"".join(lists), "<u4"), np.fromiter(map(len, lists), np.int64, len(lists)) // 4

    def of(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, latin: bool) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of words in ``data``, no two of which are equal. Ids are kept from piece to
        piece: only words that are not known are cut out and looked up."""
        if self._known.words > self._limit:
            self._known, self._before = _Known(), self._known
        two = T.word_hashes(data ^ np.uint8(0x5A), starts, ends)
        new = np.flatnonzero(self._known.find(hashes, two)[0] < 0)
        start, count = self._before.find(hashes[new], two[new])
        again = start >= 0
        if again.any():
            some = new[again]
            self._known.add(hashes[some], two[some], self._before.ids(start[again], count[again]), count[again])
        new = new[~again]
        if len(new):
            whole = data.tobytes()
            words = [whole[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            self._known.add(hashes[new], two[new], *self.ids(words, latin))
        start, count = self._known.find(hashes, two)
        return self._known.ids(start, count), count


_words: dict[str, _Words] = {}


def _encode(batches, path: str, end: int, bits: int, bounds: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if path not in _words:
        _words[path] = _Words(path, KNOWN_WORDS)
    words = _words[path]
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            data, offsets = T.raw(piece.column("text"))
            starts, ends, first = T.words(data, offsets)
            latin = len(data) == 0 or data.max() <= 0xC3
            spans = T.distinct_spans(data, starts, ends)
            if spans is None:
                distinct, number = T.distinct_words(data, starts, ends)
                flat, length = words.ids(distinct, latin)
            else:
                hashes, some, number = spans
                flat, length = words.of(data, hashes, starts[some], ends[some], latin)
            flat, length = np.append(flat, np.uint32(end)), np.r_[length, 1]
            # the end of a text is one word more
            number = np.insert(number, first[1:], len(length) - 1)
            ids = T.gather(flat, (np.cumsum(length) - length)[number], length[number])
            stops = np.r_[0, np.cumsum(length[number])[first[1:] + np.arange(len(first) - 1)]]
            counts = np.diff(stops)
            packed = [pack(ids[a:b], bits) for a, b in zip(stops, stops[1:])]
            keys = piece.column("key")
            shard = np.searchsorted(bounds, keys.fill_null(0).to_numpy(), side="right").astype(np.int32)
            shard[keys.is_null().to_numpy(zero_copy_only=False)] = 0
            columns = [pa.array(shard), keys, pa.array(counts), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _write(batches, folder: str, bits: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One shard per partition, sorted; one block of ids in memory."""
    batches = (b for b in batches if b.num_rows)
    first = next(batches, None)
    if first is None:
        return
    shard = first.column("shard")[0].as_py()
    name = f"shard-{shard:06d}.ids"
    offsets, keys, flags, starts, total, crc, size = [], [], [], [], 0, 0, 0
    waiting: list[np.ndarray] = []
    held = 0
    with files.committed(folder, name) as out:

        def put(data: bytes) -> None:
            nonlocal crc, size
            out.write(data)
            crc, size = zlib.crc32(data, crc), size + len(data)

        def flush(last: bool) -> None:
            nonlocal waiting, held
            ids = np.concatenate(waiting) if waiting else np.zeros(0, np.uint32)
            for at in range(0, len(ids) if last else len(ids) - len(ids) % BLOCK, BLOCK):
                offsets.append(size)
                put(pack(ids[at : at + BLOCK], bits))
            rest = ids[:0] if last else ids[len(ids) - len(ids) % BLOCK :]
            waiting, held = [rest], len(rest)

        put(MAGIC + struct.pack("<II", bits, BLOCK))
        for batch in itertools.chain([first], batches):
            key = batch.column("key")
            keys.append(key.fill_null(0).to_numpy())
            flags.append(key.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
            counts = batch.column("n").to_numpy()
            ends = total + np.cumsum(counts)
            starts.append(ends - counts)
            total = int(ends[-1])
            for n, packed in zip(counts, batch.column("packed")):
                waiting.append(unpack(packed.as_buffer(), int(n), bits))
                held += int(n)
                if held >= 64 * BLOCK:
                    flush(False)
        flush(True)
        offsets.append(size)
        documents = sum(map(len, keys))
        put(np.array(offsets, "<u8").tobytes())
        put(np.concatenate(keys).astype("<i8").tobytes())
        put(np.concatenate(flags).tobytes())
        put(np.r_[np.concatenate(starts), total].astype("<u8").tobytes())
        put(struct.pack("<QQQ", len(offsets) - 1, documents, total) + MAGIC)
    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (shard, name, documents, total, size, crc)], names=schema.names).cast(schema)


class TokenFile:
    """Random access to one file."""

    def __init__(self, file):
        self._file = file
        file.seek(0)
        head = file.read(16)
        self.bits, self.block = struct.unpack("<II", head[8:])
        end = file.size()
        file.seek(end - 32)
        tail = file.read(32)
        if head[:8] != MAGIC or tail[24:] != MAGIC:
            raise ValueError("not a whole token file")
        blocks, documents, self.tokens = struct.unpack("<QQQ", tail[:24])
        foot = 8 * (blocks + 1) + 17 * documents + 8
        file.seek(end - 32 - foot)
        data = file.read(foot)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        self.keys = np.frombuffer(data, "<i8", documents, at)
        self.null = np.frombuffer(data, np.uint8, documents, at + 8 * documents).astype(bool)
        self.starts = np.frombuffer(data, "<u8", documents + 1, at + 9 * documents).astype(np.int64)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids from ``begin`` up to ``end`` of this file."""
        if end <= begin:
            return np.zeros(0, np.uint32)
        a, b = begin // self.block, (end - 1) // self.block + 1
        self._file.seek(self.offsets[a])
        data = self._file.read(int(self.offsets[b] - self.offsets[a]))
        # full blocks end on whole bytes, so several are unpacked as one
        n = min(b * self.block, self.tokens) - a * self.block
        return unpack(data, n, self.bits)[begin - a * self.block : end - a * self.block]


def _read(batches, folder: str, schema: pa.Schema, step: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with files.opened(folder, row["file"]) as file:
                tokens = TokenFile(file)
                done = 0
                while done < len(tokens.keys):
                    # as many documents as fit into a step, one at least
                    stop = max(done + 1, int(np.searchsorted(tokens.starts, tokens.starts[done] + step, side="right")) - 1)
                    at = tokens.starts[done : stop + 1]
                    ids = tokens.ids(int(at[0]), int(at[-1])).astype("<u4")
                    data, ends = memoryview(ids.tobytes()), (4 * (at - at[0])).tolist()
                    crc = [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])]
                    columns = [
                        pa.array(tokens.keys[done:stop], pa.int64(), mask=tokens.null[done:stop]),
                        pa.array(row["start"] + at[:-1], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(ids.view(np.int32))),
                        pa.array(crc, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
                    done = stop


def _arrow(schema: S.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def write(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of the
    key, to ``folder``; returns the manifest, a small table with a row per file.

    Null and empty texts are the end id alone. Rows with a null key come first; rows with
    the same key follow each other in the order of their ids. Other columns are ignored.
    An empty table writes an empty manifest and no files. Runs jobs when called.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = files.qualified(spark, folder)
    bits = max(1, (max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id)).bit_length())
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows, size = source.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-(size or 0) // shard_bytes))
    bounds = files.shard_bounds(source, "key", shards, rows)
    encoded_schema, manifest_schema = _arrow(ENCODED), _arrow(MANIFEST)
    written = (
        source.mapInArrow(lambda it: _encode(it, tokenizer, end_id, bits, bounds, encoded_schema), ENCODED)
        .repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("key", "packed")
        .mapInArrow(lambda it: _write(it, folder, bits, manifest_schema), MANIFEST)
    )
    written.write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (key, start, ids, crc32) of every document in the files that the manifest
    lists; the checksum is that of the ids as little-endian unsigned 32-bit integers."""
    folder = files.qualified(spark, folder)
    listed = manifest(spark, folder)
    # one row per file: small enough for one task
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    placed = listed.select("shard", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    n = max(1, listed.count())
    schema = _arrow(READ)
    return placed.repartitionById(n, "shard").mapInArrow(lambda it: _read(it, folder, schema), READ)


def digests(read_back: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of documents read back."""
    n = F.size("ids").cast("long")
    return read_back.select(F.col("key").alias("doc_id"), "start", n.alias("n_tokens"), F.col("crc32").alias("ids_crc32"))
