"""Removal of passages that occur more than once, by relative Lempel-Ziv factors.

Texts are stored in blocks, and every block is reference to all others and to itself. The
index holds anchors: of the ``WINDOW - GRAM + 1`` word grams in a window of ``WINDOW``
words, the one with the smallest hash. Equal windows have equal anchors at the same place,
and about one gram in fourteen is an anchor of some window, so the index is far smaller
than the text. A stretch is the run of windows that share an anchor.

1. Anchors that occur once in the corpus are dropped; nothing else can repeat there.
2. Stretches that occur at least twice as a whole are copies word for word. Consecutive
   ones make up a factor, taken greedily from whatever blocks have it.
3. A stretch that occurs once though its anchor repeats is where a factor begins or ends.
   There, and only there, every single window is looked up among the windows of all
   stretches with that anchor.

Factors of ``WINDOW`` words and more are the duplicate spans. A parse that takes the
longest match and goes on behind it would miss windows that lie across two factors; the
third step finds them, so the result is exactly the windows that occur at least twice
(up to collisions of 128-bit hashes).

The texts stay in their blocks: anchors, windows and spans are what is shuffled, and they
return to the block. Copies are counted in the map tasks, and joins are plain ones whose
hot keys Spark can split, so a passage in a third of all documents is no single task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tripmill.llm import text as T
from tripmill.llm.blocks import bucketed
from tripmill.sources.staging import staged

WINDOW, GRAM = 35, 10
#: Bytes of text in a block, about.
BLOCK_BYTES = 1 << 20
_SECOND = T.U64(0x94D049BB133111EB)
#: In the key whose minimum chooses an anchor, the low bits hold the place.
_PLACE_BITS = T.U64(28)
_PLACE = (T.U64(1) << _PLACE_BITS) - T.U64(1)


def _arrow(schema: S.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def stretches(h: np.ndarray, first: np.ndarray):
    """Begin, number of windows, anchor and whole hash of every stretch; ``h`` are the
    hashes of the words, ``first`` says where each text begins."""
    n = len(h)
    if n < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(T.U64), none.astype(T.U64)
    at = np.arange(n - GRAM + 1)
    grams = T.Spans(h)(at, at + GRAM)
    least = (grams >> _PLACE_BITS << _PLACE_BITS) | (_PLACE - at.astype(T.U64))  # of equal hashes the last
    reach = 1
    while 2 * reach <= WINDOW - GRAM + 1:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = WINDOW - GRAM + 1 - reach
    least = np.minimum(least[: len(least) - rest], least[rest:])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    window = np.flatnonzero(text[: n - WINDOW + 1] == text[WINDOW - 1 :])
    anchor = (_PLACE - (least[window] & _PLACE)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]][: len(anchor)])
    begin, anchor = window[new], anchor[new]
    count = np.diff(np.r_[new, len(window)])
    inside = (anchor - begin).astype(T.U64) * T.U64(0x9E3779B97F4A7C15)
    whole = T.mix(T.Spans(T.mix(h ^ _SECOND))(begin, begin + count - 1 + WINDOW) ^ inside)
    return begin, count, grams[anchor], whole


def _hashes(data: np.ndarray, offsets: np.ndarray):
    starts, ends, first = T.words(data, offsets)
    return T.word_hashes(data, starts, ends), first


def _index(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for piece in T.pieces(batch, "text", BLOCK_BYTES):
            data, offsets = T.raw(piece.column("text"))
            begin, count, anchor, whole = stretches(*_hashes(data, offsets))
            rows = piece.column("row")
            columns = [
                pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                pa.array([np.diff(offsets)], pa.list_(pa.int64())), pa.array([len(data)], pa.int64()),
                pa.array([pa.compress(data.tobytes(), codec="zstd", asbytes=True)], pa.binary()),
                pa.array([begin << 8 | count], pa.list_(pa.int64())),
                pa.array([anchor.view(np.int64)], pa.list_(pa.int64())), pa.array([whole.view(np.int64)], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
            block += 1


def _texts(blocks: pa.Table) -> tuple[bytes, np.ndarray]:
    size = blocks.column("bytes")[0].as_py()
    data = pa.decompress(blocks.column("text")[0].as_py(), decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return data, np.r_[0, np.cumsum(np.array(blocks.column("sizes")[0].as_py(), np.int64))].astype(np.int64)


WINDOWS = S.StructType([S.StructField("block", S.LongType()), S.StructField("begin", S.LongType()),
                        S.StructField("one", S.LongType()), S.StructField("two", S.LongType()),
                        S.StructField("times", S.IntegerType())])


def _windows(blocks: pa.Table, wanted: pa.Table, schema: pa.Schema) -> pa.Table:
    """Each window of the wanted stretches of one block."""
    if not wanted.num_rows:
        return schema.empty_table()
    data, offsets = _texts(blocks)
    h, _ = _hashes(np.frombuffer(data, np.uint8), offsets)
    place = wanted.column("place").to_numpy()
    count = place & 255
    ends = np.cumsum(count)
    begin = np.arange(ends[-1]) + np.repeat((place >> 8) - (ends - count), count)
    one, two = T.Spans(h)(begin, begin + WINDOW), T.Spans(T.mix(h ^ _SECOND))(begin, begin + WINDOW)
    times = np.repeat(wanted.column("times").to_numpy(), count)
    block = np.full(len(begin), blocks.column("block")[0].as_py())
    columns = [block, begin, one.view(np.int64), two.view(np.int64), times]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _cut(blocks: pa.Table, spans: pa.Table, schema: pa.Schema) -> pa.Table:
    """Texts of one block without the words that ``spans`` cover."""
    if not blocks.num_rows:
        raise ValueError("spans of a block that isn't there")
    data, offsets = _texts(blocks)
    pieces = [data[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
    total = np.array([len(p) for p in pieces], np.int64)
    first = np.r_[0, np.cumsum(total)]
    change = np.zeros(first[-1] + 1, np.int64)
    np.add.at(change, spans.column("begin").to_numpy(), 1)
    np.add.at(change, spans.column("end").to_numpy(), -1)
    keep = np.cumsum(change[:-1]) == 0
    left = np.r_[0, np.cumsum(keep)][first]
    removed = total - np.diff(left)
    kept = []
    for i, words in enumerate(pieces):
        if removed[i]:
            words = itertools.compress(words, keep[first[i] : first[i + 1]].tolist())
        kept.append(b" ".join(words).decode())
    columns = [blocks.column("rows").combine_chunks().flatten(), pa.array(kept, pa.string()), pa.array(total), pa.array(removed)]
    return pa.Table.from_arrays(columns, schema=schema)


def cut(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (row, text, n_words, n_removed): the other columns of each row as a struct, its
    kept words with one space between, and how many it had and lost.

    Words are runs of other than ASCII white space. A word goes if a window of ``WINDOW``
    words over it begins anywhere else in the table, too, also in the same text or in a
    repeated row. Null and empty texts have no words; shorter texts lose none. Every row
    gives a row; an empty table gives an empty table. Runs jobs when called.
    """
    others = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    source = docs.select(row.alias("row"), F.col(text).alias("text"))
    row_type = source.schema["row"].dataType
    longs = S.ArrayType(S.LongType())
    layout = S.StructType([
        S.StructField("block", S.LongType()), S.StructField("rows", S.ArrayType(row_type)), S.StructField("sizes", longs),
        S.StructField("bytes", S.LongType()), S.StructField("text", S.BinaryType()), S.StructField("places", longs),
        S.StructField("anchors", longs), S.StructField("wholes", longs),
    ])
    layout_schema, windows_schema = _arrow(layout), _arrow(WINDOWS)
    blocks = bucketed(source.mapInArrow(lambda it: _index(it, layout_schema), layout), "block", "dedup-blocks")

    # written, so that the joins are between plain tables, of which hot keys can be split
    repeated = blocks.select(F.explode("anchors").alias("anchor")).groupBy("anchor").count().where("count > 1")
    repeated = staged(repeated.select("anchor"), "dedup-repeated")
    every = blocks.select("block", F.explode(F.arrays_zip("places", "anchors", "wholes")).alias("s")).select(
        "block", F.col("s.places").alias("place"), F.col("s.anchors").alias("anchor"), F.col("s.wholes").alias("whole")
    )
    shared = staged(every.join(repeated, "anchor", "left_semi"), "dedup-shared")

    kinds = staged(
        shared.groupBy("anchor", "whole").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("block", "place")).alias("one")
        ),
        "dedup-stretches",
    )
    # anchors with several kinds of stretch around them: where factors begin and end
    edges = staged(kinds.groupBy("anchor").count().where("count > 1").select("anchor"), "dedup-edges")
    wanted = kinds.join(edges, "anchor", "left_semi").select(
        "one.block", "one.place", F.least("times", F.lit(2)).cast("int").alias("times")
    )
    texts = blocks.select("block", "sizes", "bytes", "text")
    windows = staged(
        texts.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(lambda a, b: _windows(a, b, windows_schema), WINDOWS),
        "dedup-windows",
    )
    again = windows.groupBy("one", "two").agg(F.sum("times").alias("n")).where("n > 1")
    again = staged(again.select("one", "two"), "dedup-again")
    single = windows.where("times = 1").join(again, ["one", "two"], "left_semi")
    spans = single.select("block", "begin", (F.col("begin") + WINDOW).alias("end"))
    copies = shared.join(kinds.where("times > 1").select("anchor", "whole"), ["anchor", "whole"], "left_semi")
    begin, count = F.shiftright("place", 8), F.col("place").bitwiseAND(F.lit(255))
    spans = spans.unionByName(copies.select("block", begin.alias("begin"), (begin + count - 1 + WINDOW).alias("end")))

    out = S.StructType([S.StructField("row", row_type), S.StructField("text", S.StringType()),
                        S.StructField("n_words", S.LongType()), S.StructField("n_removed", S.LongType())])
    out_schema = _arrow(out)
    whole = blocks.select("block", "rows", "sizes", "bytes", "text")
    return whole.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(lambda a, b: _cut(a, b, out_schema), out)


def remove(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the kept words as text, all columns and rows as they were."""
    done = cut(docs, text)
    return done.select(*[F.col("text").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
