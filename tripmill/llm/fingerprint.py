"""Context-triggered piecewise hashes of whole texts.

A hash of the last seven bytes rolls over the text; where its lowest bits are zero a piece
ends. The block size (``4 * 2**k`` bytes a piece on average) is the smallest that leaves
at most ``PIECES`` pieces, so a fingerprint is short for any text and no byte is left out.
Each piece gives a symbol of twelve bits, written as two characters:

    block size : symbols at that size : symbols at twice that size

An edit changes the symbols of the pieces it touches and no others. Two fingerprints are
compared at a block size both have, by the edit distance (insertions and deletions) of
their symbols; without a common size the likeness is 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tripmill.llm import files
from tripmill.llm import text as T
from tripmill.sources.staging import staged

WINDOW = 7
SMALLEST_BLOCK_BITS = 2
PIECES = 64
#: Bytes of text per range shard, about.
SHARD_BYTES = 1 << 24
_BYTE = T.mix(np.arange(1, 257, dtype=T.U64) * T.U64(0x9E3779B97F4A7C15))
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOLS = [a + b for a in _ALPHABET for b in _ALPHABET]
_NUMBERS = {s: i for i, s in enumerate(_SYMBOLS)}
_LEVELS = 48


def fingerprints(texts: list[bytes]) -> list[str]:
    """Fingerprint of each text; a function of its bytes alone."""
    pad = bytes(WINDOW)
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size + WINDOW)
    begins = ends - size
    spans = T.Spans(_BYTE[data])
    at = np.arange(len(data) - WINDOW + 1)
    rolled = spans.plain(at, at + WINDOW)
    cut = np.flatnonzero((rolled & T.U64((1 << SMALLEST_BLOCK_BITS) - 1)) == 0)
    lowest = rolled[cut] & (~rolled[cut] + T.U64(1))
    cut += WINDOW  # one past the byte that ends a piece
    text = np.searchsorted(begins, cut, side="left") - 1
    inside = (text >= 0) & (cut <= ends[np.maximum(text, 0)])
    cut, text, lowest = cut[inside], text[inside], lowest[inside]
    level = np.full(len(cut), _LEVELS - 1)
    some = lowest > 0
    level[some] = np.minimum(np.log2(lowest[some].astype(float)).astype(int) - SMALLEST_BLOCK_BITS, _LEVELS - 1)
    count = np.bincount(text * _LEVELS + level, minlength=len(texts) * _LEVELS).reshape(-1, _LEVELS)
    reached = count[:, ::-1].cumsum(axis=1)[:, ::-1]
    # many equal bytes can end a piece everywhere at every size: then the text is one piece
    reached = np.c_[reached, np.zeros(len(texts), int), np.zeros(len(texts), int)]
    block = np.argmax(reached < PIECES, axis=1)

    def symbols(least: np.ndarray) -> list[str]:
        stop = np.unique(np.r_[cut[level >= least[text]], ends[size > 0]])
        owner = np.searchsorted(begins, stop, side="left") - 1
        start = np.r_[0, stop[:-1]]
        first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
        start[first] = begins[owner[first]]
        number = (spans(start, stop) >> T.U64(52)).astype(int).tolist()
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        return ["".join([_SYMBOLS[i] for i in number[a:b]]) for a, b in zip(bounds, bounds[1:])]

    return [
        f"{1 << (int(k) + SMALLEST_BLOCK_BITS)}:{a}:{b}" for k, a, b in zip(block, symbols(block), symbols(block + 1))
    ]


def _common(a: list, b: list) -> int:
    """Length of the longest common subsequence, 64 cells of the table at a time."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        if y in where:
            u = row & where[y]
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def _likeness(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    left, right = ([s[i : i + 2] for i in range(0, len(s), 2)] for s in (a, b))
    # the distance is what is left of both beside the common subsequence
    return 2 * _common(left, right) / (len(left) + len(right))


def likeness(a: str, b: str) -> float:
    """From 0 to 1; equal fingerprints give 1."""
    if a == b:
        return 1.0
    (size_a, one_a, two_a), (size_b, one_b, two_b) = a.split(":"), b.split(":")
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(_likeness(one_a, one_b), _likeness(two_a, two_b))
    if size_a == 2 * size_b:
        return _likeness(one_a, two_b)
    if size_b == 2 * size_a:
        return _likeness(two_a, one_b)
    return 0.0


ROW = S.StructType([S.StructField("doc_id", S.LongType()), S.StructField("n_chars", S.LongType()),
                    S.StructField("edited_sha256", S.StringType()), S.StructField("fingerprint", S.StringType()),
                    S.StructField("edited_fingerprint", S.StringType()), S.StructField("near_edited", S.DoubleType()),
                    S.StructField("near_next", S.DoubleType())])
#: What a shard leaves open: 1 its last document, 2 the text of its first.
SHARD_ROW = S.StructType([*ROW.fields, S.StructField("shard", S.IntegerType()), S.StructField("open", S.IntegerType()),
                          S.StructField("text", S.StringType())])


def edited(text: str, after: str) -> str:
    """The last quarter of ``text`` replaced by the beginning of ``after``."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def _rows(keys: list, texts: list[str], marks: list[str], following: list[str], next_marks: list[str]) -> list[list]:
    changed = [edited(a, b).encode() for a, b in zip(texts, following)]
    new = fingerprints(changed)
    return [
        keys, list(map(len, texts)), [hashlib.sha256(c).hexdigest() for c in changed], marks, new,
        list(map(likeness, marks, new)), list(map(likeness, marks, next_marks)),
    ]


def _shard(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One shard, in order. The last document waits for the next batch."""

    def out(rows: list[list], shard: int, open_: int, text) -> pa.RecordBatch:
        n = len(rows[0])
        columns = [*rows, [shard] * n, [open_] * n, text or [None] * n]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    keys, texts, marks, shard = [], [], [], None
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            more = [t or "" for t in piece.column("text").to_pylist()]
            found = fingerprints([t.encode() for t in more])
            if shard is None:
                shard = piece.column("shard")[0].as_py()
                empty = [[None]] * 2
                yield out([*empty, [None], found[:1], [None], [None], [None]], shard, 2, more[:1])
            keys, texts, marks = keys + piece.column("key").to_pylist(), texts + more, marks + found
            if len(keys) > 1:
                yield out(_rows(keys[:-1], texts[:-1], marks[:-1], texts[1:], marks[1:]), shard, 0, None)
                keys, texts, marks = keys[-1:], texts[-1:], marks[-1:]
    if keys:
        yield out([keys, [None], [None], marks, [None], [None], [None]], shard, 1, texts)


def _seams(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts, marks, following, next_marks = (c.to_pylist() for c in batch.columns)
        columns = _rows(keys, texts, marks, following, next_marks)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _arrow(schema: S.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next): every text beside its edited text and the next document's.

    Next is the next row in order of key, then text; after the last comes the first. Null
    keys come first; a null text is empty. Every row gives a row, repeated ones too; other
    columns are ignored; an empty table gives an empty table. Texts are shuffled once, by
    range of the key; where two ranges meet, one text of each goes through a second, small
    step. Runs jobs when called.
    """
    source = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, size = source.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    bounds = files.shard_bounds(source, "key", max(1, -(-(size or 0) // shard_bytes)), rows)

    @F.pandas_udf("int")
    def shard_of(ids):
        return ids.isna().map({True: 0, False: 1}) * np.searchsorted(bounds, ids.fillna(0).astype("int64"), side="right")

    shard_schema, row_schema = _arrow(SHARD_ROW), _arrow(ROW)
    done = staged(
        source.withColumn("shard", shard_of("key"))
        .repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions("key", "text")
        .mapInArrow(lambda it: _shard(it, shard_schema), SHARD_ROW),
        "fingerprints",
    )
    whole = done.where("open = 0").select(*ROW.names)
    # one row per shard
    opening = done.where("open = 2").select("shard", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark"))
    every = W.partitionBy()
    order = opening.select("shard").withColumn("follows", F.lag("shard").over(W.orderBy("shard")))
    order = order.select(F.col("shard"), F.coalesce("follows", F.max("shard").over(every)).alias("follows"))
    last = done.where("open = 1").select(F.col("shard").alias("follows"), "doc_id", "text", "fingerprint")
    seams = last.join(order, "follows").join(opening, "shard").select("doc_id", "text", "fingerprint", "next_text", "next_mark")
    return whole.unionByName(seams.mapInArrow(lambda it: _seams(it, row_schema), ROW))
