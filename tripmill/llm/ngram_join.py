"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

Equal sets are one class from the start, and a class has one representative. For the
others the prefix principle holds: in any order of the n-grams that is the same for all
documents, two sets with overlap ``t`` share at least ``l`` of their first
``size - t + l``. So documents that share fewer can't be linked, and the longer the
prefix, the more n-grams they must share. How long a prefix is depends on what candidates
it would give:

1. Every representative has a prefix in order of hash. In that order, linked sets also share
   pairs of neighbours: of all that both share up to where the first of two prefixes ends, only
   those with an n-gram of one set alone in between are none. If too many pairs of a prefix
   occur in no other one, the document has no candidate and is done; that holds for nearly all.
   Common passages hardly matter, as n-grams of different ones are neighbours.
2. The rest lengthen their prefix to the whole set. Those with so many n-grams of their
   own that no overlap can reach the threshold are done.
3. What remains is indexed by its rarest n-grams, by counts among what remains: in a pair
   the smaller set needs fewer of them than the larger one, as its overlap must be larger.
   Every document has a prefix that is lengthened for ``l`` matches, with the ``l`` that costs
   least by estimate: each candidate of the shortest prefix is looked at in the longer one,
   and those that are left, at most an ``l``-th of the members of its lists, are compared as
   whole sets. Rare n-grams make a longer prefix worth it; where the next ones are those of
   a common passage, the prefix ends before them.

In each list of the index all members are compared with the one that has the fewest
n-grams of its own, which connects a group of near copies by as many comparisons as it has
members. Further pairs are looked at only between components that are still apart. In a long
list those that share half with its middle member are told by the n-grams by which they differ
from what most have: linked pairs differ by little or in the same n-grams, and the prefix
principle holds for these as well. All others are pairs of their list. After a
bound on their overlap, the n-grams that their prefixes share are counted, and whole sets
are compared only where they share as many as the smaller of the two numbers ``l``. No list
is cut, and every comparison is of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tripmill.llm import text as T
from tripmill.llm.blocks import bucketed, few_files, shuffles_dropped
from tripmill.llm.components import components
from tripmill.sources.staging import staged, staging_scope

WORDS, PERCENT = 3, 90
BLOCK_BYTES = 1 << 20
#: The first prefix is lengthened by one n-gram for so many of its set.
EXTRA = 40
#: Matches for which a prefix may be lengthened.
MOST_MATCHES = 8
#: Members of a list beyond which those close to its middle one are compared by their diffs.
LONG_LIST = 32
_SECOND = T.U64(0x94D049BB133111EB)


def _arrow(schema: S.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def ngram_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct n-grams of each text, sorted, one text after another, and
    where each text begins. With fewer words than ``words`` all of them are one n-gram."""
    data = T.ascii_lower(data)
    starts, ends, first = T.words(data, offsets)
    spans = T.Spans(T.word_hashes(data, starts, ends))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin = np.arange(len(starts))
    end = np.minimum(begin + words, first[1:][text]) if len(text) else begin
    whole = (end - begin == words) | (begin == first[:-1][text]) if len(text) else np.zeros(0, bool)
    text, hashes = text[whole], spans(begin[whole], end[whole])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])][: len(text)]
    return hashes[new], np.searchsorted(text[new], np.arange(len(offsets)))


def _index(batches, words: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for piece in T.pieces(batch, "text", BLOCK_BYTES):
            data, offsets = T.raw(piece.column("text"))
            grams, first = ngram_sets(data, offsets, words)
            # sums of scrambled hashes tell sets apart whatever their order
            signs = [
                np.diff(np.r_[T.U64(0), np.cumsum(T.mix(grams ^ seed), dtype=T.U64)][first]).view(np.int64)
                for seed in (_SECOND, ~_SECOND)
            ]
            size = np.diff(first)
            docs = pa.StructArray.from_arrays(
                [pa.array(np.arange(len(size))), piece.column("key"), pa.array(size), *map(pa.array, signs)],
                names=["at", "key", "n", "one", "two"],
            )
            columns = [
                pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), piece.column("rest")),
                pa.array([np.diff(offsets)], pa.list_(pa.int64())), pa.array([len(data)], pa.int64()),
                pa.array([pa.compress(data.tobytes(), codec="zstd", asbytes=True)], pa.binary()),
                pa.array([np.flatnonzero(piece.column("text").is_null().to_numpy(zero_copy_only=False))], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
            block += 1


def _texts(blocks: pa.Table) -> tuple[bytes, np.ndarray]:
    size = blocks.column("bytes")[0].as_py()
    data = pa.decompress(blocks.column("text")[0].as_py(), decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return data, np.r_[0, np.cumsum(np.array(blocks.column("sizes")[0].as_py(), np.int64))].astype(np.int64)


def _sets_of(blocks: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = _texts(blocks)
    return ngram_sets(np.frombuffer(data, np.uint8), offsets, words)


GRAMS = S.StructType([S.StructField("block", S.LongType()), S.StructField("at", S.LongType()),
                      S.StructField("gram", S.LongType())])
SETS = S.StructType([S.StructField("block", S.LongType()), S.StructField("at", S.LongType()),
                     S.StructField("grams", S.ArrayType(S.LongType()))])


def _grams(blocks: pa.Table, wanted: pa.Table, words: int, schema: pa.Schema, pairs: bool = False) -> pa.Table:
    """The first ``take`` n-grams, by hash, of each wanted document of one block, or the
    ``pairs`` of neighbours among them."""
    if not wanted.num_rows:
        return schema.empty_table()
    grams, first = _sets_of(blocks, words)
    at = wanted.column("at").to_numpy()
    count = np.minimum(wanted.column("take").to_numpy(), np.diff(first)[at])
    chosen = T.gather(grams, first[at], count)
    at = np.repeat(at, count)
    if pairs:
        same = at[1:] == at[:-1]
        # 48 bits: pairs that are mistaken for equal ones only keep a document
        at, chosen = at[1:][same], T.mix(T.mix(chosen[:-1]) + chosen[1:])[same] >> T.U64(16)
    columns = [np.full(len(chosen), blocks.column("block")[0].as_py()), at, chosen.view(np.int64)]
    return pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema)


def _whole_sets(blocks: pa.Table, wanted: pa.Table, words: int, schema: pa.Schema) -> pa.Table:
    if not wanted.num_rows:
        return schema.empty_table()
    grams, first = _sets_of(blocks, words)
    at = wanted.column("at").to_numpy()
    count = np.diff(first)[at]
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), pa.array(T.gather(grams, first[at], count).view(np.int64)))
    block = np.full(len(at), blocks.column("block")[0].as_py())
    return pa.Table.from_arrays([pa.array(block), pa.array(at), lists], schema=schema)


def _kept(blocks: pa.Table, wanted: pa.Table, schema: pa.Schema) -> pa.Table:
    """The wanted rows of one block, with all columns."""
    if not wanted.num_rows:
        return schema.empty_table()
    data, offsets = _texts(blocks)
    at = np.sort(wanted.column("at").to_numpy())
    missing = blocks.column("missing")[0].as_py()
    texts = [None if i in missing else data[offsets[i] : offsets[i + 1]].decode() for i in at.tolist()]
    rest = blocks.column("rest").combine_chunks().flatten().take(pa.array(at))
    return pa.Table.from_arrays([rest, pa.array(texts, pa.string())], schema=schema)


class _Bounds:
    """What a similarity of ``percent`` asks of two sets, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def overlap(self, n: Column) -> Column:
        """With a set of any size."""
        return F.ceil(n * self.percent / 100.0 - 1e-9).cast("long")

    def overlap_as_smaller(self, n: Column) -> Column:
        """With a set that is no smaller."""
        return F.ceil(n * (2 * self.percent) / (100.0 + self.percent) - 1e-9).cast("long")

    def extra(self, n: Column) -> Column:
        """How many pairs a first prefix shares at least with a linked set's, if it is no
        shorter than asked; never fewer for a larger set."""
        return F.floor(n / EXTRA).cast("long") + 3

    @property
    def _apart(self) -> float:
        """What may part neighbours of a set, as a share of its size: each of its n-grams that a
        linked set lacks takes itself and one pair, each that it lacks itself one pair."""
        return max(2 * (100 - self.percent) / 100, (100 - self.percent) / self.percent)

    def prefix(self, n: Column) -> Column:
        """Length of the first prefix, of which ``l`` n-grams have ``l - 1`` pairs."""
        return F.least(n, F.floor(n * self._apart + 1e-9).cast("long") + 1 + self.extra(n))

    def pairs(self, n: Column) -> Column:
        """How many pairs of a first prefix are shared with that of any linked set: what the
        shorter one shares at least, be that of the smallest possible set."""
        least = self.overlap(n)
        return F.least(self.extra(least), F.ceil(least * (1 - self._apart) - 1e-9).cast("long") - 1)

    def possible(self, n: Column, own: Column, other_n: Column, other_own: Column) -> Column:
        """Whether sets with so many n-grams of their own can overlap enough."""
        most = F.least(n - own, other_n - other_own)
        return (100 + self.percent) * most >= self.percent * (n + other_n)

    def excess(self, diff: Column, n: Column) -> Column:
        """Of a set that differs by ``diff`` n-grams from another: two sets are linked if theirs add
        up to no more than ``shared_excess`` of the n-grams by which both differ from it."""
        return (100 + self.percent) * diff.cast("long") - (100 - self.percent) * n

    def shared_excess(self, both: Column) -> Column:
        return 2 * (100 + self.percent) * both

    def linked(self, both: Column, n: Column, other_n: Column) -> Column:
        return 100 * both >= self.percent * (n + other_n - both)


def _larger_first() -> Column:
    return (F.col("x_n") > F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_row") > F.col("y_row")))


def _both(x: DataFrame, y: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of rows of different components that agree in ``on``, the larger set as x."""
    x, y = (some.select(*on, *[F.col(c).alias(f"{side}_{c}") for c in some.columns if c not in on]) for some, side in ((x, "x"), (y, "y")))
    return x.join(y, on).where((F.col("x_root") != F.col("y_root")) & _larger_first())


def _across(x: DataFrame, y: DataFrame, need: _Bounds) -> DataFrame:
    """Pairs (a, b), a the smaller set, of the members of the same lists."""
    columns = ("gram", "row", "n", "own", "root")
    possible = need.possible(F.col("x_n"), F.col("x_own"), F.col("y_n"), F.col("y_own"))
    pairs = _both(x.select(*columns), y.where("as_smaller").select(*columns), ["gram"])
    return pairs.where(possible).select(F.col("y_row").alias("a"), F.col("x_row").alias("b"))


def _told_apart(held: DataFrame, sets: DataFrame, need: _Bounds) -> DataFrame:
    """Rows (row, mid, n, root, diff, excess) of the members of lists that share at least half
    with the middle one, ``mid``: by which n-grams they differ from what most of these have.

    That is the set of the middle one but for the n-grams by which more than half differ from it.
    Sets that differ by x and y from any third set differ by ``|x| + |y| - 2 * |x and y|`` from
    each other. So two are linked exactly if their ``excess`` adds up to no more than
    ``2 * (100 + percent)`` for each n-gram that both diffs have.
    """
    # each written before it meets the sets, so that few of them don't have all sets shuffled
    asked = staged(held.select("row", "mid", "n", "root").distinct(), "join-asked")
    asked = staged(asked.join(sets, "row"), "join-asked-sets")
    both = asked.join(sets.select(F.col("row").alias("mid"), F.col("grams").alias("mid_grams")), "mid")
    diff = F.concat(F.array_except("grams", "mid_grams"), F.array_except("mid_grams", "grams"))
    both = both.withColumn("diff", diff).where(3 * F.size("diff") <= F.size("grams") + F.size("mid_grams"))
    close = staged(both.select("row", "mid", "n", "root", "diff"), "join-told")
    members = close.groupBy("mid").agg(F.count(F.lit(1)).alias("members"))
    times = close.select("mid", F.explode("diff").alias("gram")).groupBy("mid", "gram").agg(F.count(F.lit(1)).alias("times"))
    most = times.join(members, "mid").where("2 * times > members").groupBy("mid").agg(F.collect_list("gram").alias("most"))
    close = close.join(most, "mid", "left").withColumn("most", F.coalesce("most", F.array().cast("array<bigint>")))
    close = close.withColumn("diff", F.concat(F.array_except("diff", "most"), F.array_except("most", "diff"))).drop("most")
    return close.withColumn("excess", need.excess(F.size("diff"), F.col("n")))


def _close_pairs(close: DataFrame, need: _Bounds) -> DataFrame:
    """Pairs (a, b), a the smaller set, among those of ``_told_apart`` that connect all of the same
    middle that are linked."""
    # with an excess of no more than zero together: then each is linked to that of the least
    least = close.groupBy("mid").agg(F.min(F.struct("excess", "row", "n", "root")).alias("o"))
    sure = close.join(least, "mid").where((F.col("excess") + F.col("o.excess") <= 0) & (F.col("root") != F.col("o.root")))
    this, other = F.struct("n", "row"), F.struct("o.n", "o.row")
    sure = sure.select(F.least(this, other)["row"].alias("a"), F.greatest(this, other)["row"].alias("b"))

    # the others have n-grams of their diffs in common: prefixes of the rarest of them
    grams = close.select("row", "mid", "n", "root", "excess", F.explode("diff").alias("gram"))
    ends = F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("times")
    shared = grams.groupBy("mid", "gram").agg(*ends).where("low <> high").select("mid", "gram", "times")
    own = Window.partitionBy("mid", "row")
    place = F.row_number().over(own.orderBy(F.desc("times"), F.desc("gram"))).cast("long")
    # from this one to the last
    index = grams.join(shared, ["mid", "gram"]).withColumn("left", place).drop("times")
    index = staged(index, "join-diffs")
    pairs = _both(index, index, ["mid", "gram"])
    together = F.col("x_excess") + F.col("y_excess")
    pairs = pairs.where((together > 0) & (together <= need.shared_excess(F.least("x_left", "y_left"))))
    return sure.unionByName(pairs.select(F.col("y_row").alias("a"), F.col("x_row").alias("b")))


def _matches(need: _Bounds) -> Column:
    """For how many matches the prefix of a set (n, own, rare) is lengthened: the number of
    the least estimated cost, and of the overlap that any partner needs at most.

    The candidates are the members of the lists of the shortest prefix. Each costs a look at
    the prefix; those that are left cost a look at the whole set. As one that is met ``l``
    times is counted that often among the members of the longer prefix's lists, an ``l``-th
    of those can be left, and no more than there were.
    """
    n, shortest = F.col("n"), F.col("n") - need.overlap(F.col("n")) - F.col("own")

    def members(matches: Column) -> Column:
        length = F.greatest(shortest + matches, F.lit(0)).cast("int")
        return F.aggregate(F.slice("rare", F.lit(1), length), F.lit(0).cast("long"), lambda a, g: a + g["times"])

    def cost(matches: Column) -> Column:
        candidates = members(F.lit(1))
        left = F.least(members(matches) / matches, candidates.cast("double"))
        return F.struct((candidates * (shortest + matches) + left * n).alias("cost"), matches.alias("matches"))

    choices = F.sequence(F.lit(1).cast("long"), F.least(F.lit(MOST_MATCHES).cast("long"), F.greatest(need.overlap(n), F.lit(1))))
    return F.array_min(F.transform(choices, cost))["matches"]


def _blocks(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    source = docs.select(F.col(key).alias("key"), rest.alias("rest"), F.col(text).alias("text"))
    doc = S.StructType([S.StructField("at", S.LongType()), source.schema["key"], S.StructField("n", S.LongType()),
                        S.StructField("one", S.LongType()), S.StructField("two", S.LongType())])
    layout = S.StructType([
        S.StructField("block", S.LongType()), S.StructField("docs", S.ArrayType(doc)),
        S.StructField("rest", S.ArrayType(source.schema["rest"].dataType)), S.StructField("sizes", S.ArrayType(S.LongType())),
        S.StructField("bytes", S.LongType()), S.StructField("text", S.BinaryType()),
        S.StructField("missing", S.ArrayType(S.LongType())),
    ])
    schema = _arrow(layout)
    return bucketed(source.mapInArrow(lambda it: _index(it, words, schema), layout), "block", "join-blocks")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows (row, key, n_shingles, class, root): each document with the size of its set,
    the representative of its equals and the least representative it is connected with.

    Words are runs of other than ASCII white space, A-Z in lower case. A null or empty text
    has no n-grams and is linked with nothing, not even with another such text. Every row
    of the table is a document, also one that repeats another or has a null key; other
    columns are ignored; an empty table gives an empty table. Runs jobs when called.
    """
    return _join(_blocks(docs.select(key, text), key, text, words), words, percent).withColumnsRenamed(
        {"key": key, "n": "n_shingles"}
    )


def _join(blocks: DataFrame, words: int, percent: int) -> DataFrame:
    spark = blocks.sparkSession
    row = F.struct("block", "at").alias("row")
    rows = blocks.select("block", F.explode("docs").alias("d")).select("block", "d.*").withColumn("row", row)
    full = rows.where("n > 0")
    n_docs = blocks.agg(F.sum(F.size("docs"))).first()[0] or 0
    with shuffles_dropped(spark):
        classes = full.groupBy("one", "two", "n").agg(F.min("row").alias("class"))
        classes = staged(few_files(classes, n_docs), "join-classes")
        # nothing of what is written on the way to the links is read after them
        with staging_scope(spark):
            found = _links(blocks, classes, n_docs, words, percent)
            roots = staged(components(found).withColumnRenamed("node", "class"), "join-roots", None, True)
    named = full.join(classes, ["one", "two", "n"]).join(roots, "class", "left")
    named = named.select("row", "key", "n", "class", F.coalesce("root", "class").alias("root"))
    empty = rows.where("n = 0").select("row", "key", "n", F.col("row").alias("class"), F.col("row").alias("root"))
    return named.unionByName(empty)


def _links(blocks: DataFrame, classes: DataFrame, n_docs: int, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of linked representatives, enough of them to connect all that are."""
    need = _Bounds(percent)
    spark = blocks.sparkSession
    row = F.struct("block", "at").alias("row")
    grams_schema, sets_schema = _arrow(GRAMS), _arrow(SETS)
    texts = blocks.select("block", "sizes", "bytes", "text")

    def from_blocks(wanted: DataFrame, work, schema: S.StructType) -> DataFrame:
        return texts.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(work, schema)

    def stored(some: DataFrame, label: str, *options) -> DataFrame:
        """Written: a row per document at most."""
        return staged(few_files(some, n_docs), label, *options)

    chosen = classes.select("class.block", "class.at", "n")

    # 1. prefixes by hash: how many of their pairs occur in no other prefix
    first = chosen.select("block", "at", "n", need.prefix(F.col("n")).alias("take"))
    pairs = from_blocks(first, lambda a, b: _grams(a, b, words, grams_schema, pairs=True), GRAMS)

    def with_own(some: DataFrame, grams: DataFrame) -> DataFrame:
        alone = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("times"), F.min("block").alias("block"), F.min("at").alias("at"))
        own = alone.where("times = 1").groupBy("block", "at").agg(F.count(F.lit(1)).alias("own"))
        return some.join(own, ["block", "at"], "left").withColumn("own", F.coalesce("own", F.lit(0).cast("long")))

    shared = F.col("take") - 1 - F.col("own")
    playing = stored(with_own(first, pairs).where(shared >= need.pairs(F.col("n"))).select("block", "at", "n"), "join-playing")

    # 2. whole sets of those: n-grams of their own can't be shared
    whole = from_blocks(playing.withColumn("take", F.col("n")), lambda a, b: _grams(a, b, words, grams_schema), GRAMS)
    able = stored(with_own(playing, whole).where(F.col("n") - F.col("own") >= need.overlap(F.col("n"))).select("block", "at", "n"), "join-able")

    # 3. their rarest n-grams
    with staging_scope(spark):
        grams = staged(
            from_blocks(able.withColumn("take", F.col("n")), lambda a, b: _grams(a, b, words, grams_schema), GRAMS), "join-grams"
        )
        # written, so that its shuffle is gone before that of the lists
        counts = staged(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "join-counts")
        # as many as the document has; two lists in the same order are half as large as one of structs
        rarest = F.sort_array(F.arrays_zip(F.collect_list("times").alias("times"), F.collect_list("gram").alias("gram")))
        lists = grams.join(counts, "gram").groupBy("block", "at").agg(rarest.alias("rare")).join(able, ["block", "at"])
        lists = lists.withColumn("own", F.col("n") - F.size("rare"))
        larger = F.col("n") - need.overlap(F.col("n")) - F.col("own")
        smaller = F.col("n") - need.overlap_as_smaller(F.col("n")) - F.col("own")
        lists = lists.where(larger >= 0).withColumn("matches", _matches(need))
        lists = lists.select(
            row, "n", "own", "matches", F.transform("rare", lambda g: g["gram"]).alias("rare"),
            *[(c + extra).cast("int").alias(f"{name}{suffix}") for name, c in (("larger", larger), ("smaller", smaller))
              for suffix, extra in (("", 1), ("_long", F.col("matches")))],
        )
        rare = lambda size: F.slice("rare", F.lit(1), F.greatest(F.col(size), F.lit(0)))
        lists = stored(lists.withColumn("rare", F.slice("rare", F.lit(1), F.col("larger_long"))), "join-prefixes", None, True)
    prefixes = lists.select("row", "matches", rare("larger_long").alias("larger"), rare("smaller_long").alias("smaller"))
    index = lists.select("row", "n", "own", "smaller", F.posexplode(rare("larger")).alias("place", "gram"))
    index = staged(index.select("row", "n", "own", "gram", (F.col("place") < F.col("smaller")).alias("as_smaller")), "join-index")
    members = index.select("row").distinct().select("row.block", "row.at")
    sets = staged(from_blocks(members, lambda a, b: _whole_sets(a, b, words, sets_schema), SETS), "join-sets")
    sets = sets.select(row, "grams")

    def links(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of rows that are linked, by their whole sets."""
        left = sets.select(F.col("row").alias("a"), F.col("grams").alias("a_grams"))
        right = sets.select(F.col("row").alias("b"), F.col("grams").alias("b_grams"))
        both = F.size(F.array_intersect("a_grams", "b_grams"))
        compared = pairs.join(left, "a").join(right, "b")
        linked = need.linked(both, F.size("a_grams"), F.size("b_grams"))
        return staged(compared.where(linked).select("a", "b"), "join-links")

    # the member with the smallest share of own n-grams stands for its list
    middle = F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "row", "n", "own")).alias("m")
    middles = index.groupBy("gram").agg(middle, F.count(F.lit(1)).alias("times")).where("times > 1").select("gram", "m")
    near = index.join(middles, "gram").where(F.col("row") != F.col("m.row"))
    near = near.where(need.possible(F.col("n"), F.col("own"), F.col("m.n"), F.col("m.own")))
    pairs = near.select(F.least("row", "m.row").alias("a"), F.greatest("row", "m.row").alias("b")).distinct()
    found = links(pairs)

    # pairs between components that are still apart
    joined = index.join(components(found).withColumnRenamed("node", "row"), "row", "left")
    joined = staged(joined.withColumn("root", F.coalesce("root", "row")), "join-apart")
    ends = F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("times")
    apart = joined.groupBy("gram").agg(*ends).where("low <> high").select("gram", (F.col("times") > LONG_LIST).alias("long"))
    opened = staged(joined.join(apart, "gram"), "join-opened")
    short = opened.where("not long")
    # the middle member of a long list was compared with all others of it
    held = opened.where("long")
    held = held.join(held.groupBy("gram").agg(middle).select("gram", F.col("m.row").alias("mid")), "gram").where("row <> mid")
    close = staged(_told_apart(held, sets, need), "join-close")
    held = held.join(close.select("row", "mid", F.lit(True).alias("close")), ["row", "mid"], "left")
    held = staged(held.withColumn("close", F.coalesce("close", F.lit(False))), "join-held")
    far = held.where("not close")
    across = [_across(x, y, need) for x, y in ((short, short), (far, held), (held.where("close"), far))]
    across = reduce(DataFrame.unionByName, [*across, _close_pairs(close, need)])
    pairs = staged(across.distinct(), "join-pairs")
    # prefixes for l matches share l n-grams, and the longer of two contains one for the fewer
    low = prefixes.select(F.col("row").alias("a"), F.col("matches").alias("a_matches"), F.col("smaller").alias("a_prefix"))
    high = prefixes.select(F.col("row").alias("b"), F.col("matches").alias("b_matches"), F.col("larger").alias("b_prefix"))
    shared = F.size(F.array_intersect("a_prefix", "b_prefix"))
    pairs = pairs.join(low, "a").join(high, "b").where(shared >= F.least("a_matches", "b_matches")).select("a", "b")
    return found.unionByName(links(pairs))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows (key, n_shingles, component_id): the component's smallest key names it. Null
    keys are passed over; a component with null keys alone has a null name."""
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        with staging_scope(spark):
            joined = staged(join(docs, key, text, **options), "join-result", None, True)
        # written, so that the join is between plain tables and a large component can be split
        names = staged(joined.groupBy("root").agg(F.min(key).alias("component_id")), "join-names")
    return joined.join(names, "root").select(key, "n_shingles", "component_id")


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were: that with the
    smallest key (null keys last), of rows with the same key the first stored. Documents
    without n-grams all stay."""
    blocks = _blocks(docs, key, text, words)
    joined = _join(blocks, words, percent)
    first = joined.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("m"))
    wanted = first.select("m.row.block", "m.row.at")
    stored = blocks.select("block", "rest", "sizes", "bytes", "text", "missing")
    out = S.StructType([S.StructField("rest", blocks.schema["rest"].dataType.elementType), S.StructField("text", S.StringType())])
    schema = _arrow(out)
    kept = stored.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(lambda a, b: _kept(a, b, schema), out)
    return kept.select(*[F.col("text").alias(text) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
