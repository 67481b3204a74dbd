"""Shards of even size by sampled splitters.

Rows have a total order: a digest of their group (equal texts), their key, a row number.
Sizes are summed exactly, yet no task sorts all rows: samples drawn with a chance that
grows with a row's size give splitters, quantiles of the sample, and the rows between two
splitters are a range. The sizes of all ranges are then counted. A range that holds too
much is subdivided by a sample of its own: between groups as long as it holds several,
within the group, by key, where it is a single one. Ranges are sorted each on its own and
shifted by the exact totals of the ranges before them.

The shard of a row follows from where its middle lies among all bytes. A group of up to
``WHOLE`` of a shard, or of the size of the largest row, isn't cut: its middle counts for
all its rows. So shards differ by that much at most, whatever the samples were.

All of it is built-in functions. Only sizes, digests and keys are shuffled.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.blocks import few_files
from tripmill.sources.staging import staged

SHARDS = 16
#: A group of at most 1/WHOLE of a shard stays in one shard.
WHOLE = 32
#: Ranges: so many a shard, more where a range would have over ``RANGE_ROWS`` rows, up to ``MOST_RANGES``.
RANGES_PER_SHARD, RANGE_ROWS, MOST_RANGES = 8, 250_000, 1 << 14
#: Expected samples per range. The driver holds a multiple of ``MOST_RANGES`` numbers at most.
SAMPLES = 16

_LEAST = -(2**63)
Splitter = tuple[int, int, int]  # group, key, row number: where a range begins


def text_group(text: str = "text") -> Column:
    """60 bits of the SHA-256 of a text (null: empty), as a number."""
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _key(df: DataFrame, key: str) -> Column:
    """Keys as numbers in their order, nulls first; keys that are no numbers by their hash."""
    whole = df.schema[key].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(F.col(key).cast("long") if whole else F.xxhash64(key), F.lit(_LEAST))


def _range_of(splitters: list[Splitter]) -> Column:
    """How many splitters are not above a row, by halving; 0 is the first range."""
    if not splitters:
        return F.lit(0)
    g, k, r = (F.lit(np.array(x, dtype=np.int64)) for x in zip(*splitters))
    n = len(splitters)
    steps = F.lit(np.array([1 << i for i in range(n.bit_length() - 1, -1, -1)], dtype=np.int32))

    def go(at: Column, step: Column) -> Column:
        def on(some: Column, column: str) -> tuple[Column, Column]:
            value = F.get(some, at + step - 1)
            return value < F.col(column), value == F.col(column)

        (g_below, g_same), (k_below, k_same) = on(g, "g"), on(k, "k")
        reached = g_below | (g_same & (k_below | (k_same & (F.get(r, at + step - 1) <= F.col("row")))))
        return F.when((at + step <= n) & reached, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), go)


def _sampled(rows: DataFrame, every: Column, within_groups: bool, quantiles: int) -> dict[int, list[tuple]]:
    """Quantiles of a sample of each range, (g, k, row) by range.

    A row of ``size`` is drawn ``size / every`` times on average, decided by a hash of its
    place in the order, so a second run draws the same rows.
    """
    chance = F.pmod(F.xxhash64("g", "k", "row"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    drawn = rows.withColumn("weight", F.floor(F.col("size") / every + chance)).where("weight > 0")
    if not within_groups:  # one row a group: only the group's place matters
        drawn = drawn.groupBy("range", "g").agg(F.sum("weight").alias("weight")).withColumns({"k": F.lit(_LEAST), "row": F.lit(_LEAST)})
    # a bounded number of samples a range
    in_range = Window.partitionBy("range")
    upto = F.sum("weight").over(in_range.orderBy("g", "k", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = drawn.withColumn("upto", upto).withColumn("all", F.sum("weight").over(in_range))
    step = F.floor(F.col("upto") * quantiles / F.col("all"))
    before = F.floor((F.col("upto") - F.col("weight")) * quantiles / F.col("all"))
    found: dict[int, list[tuple]] = {}
    for row in sums.where(step > before).select("range", "g", "k", "row").collect():
        found.setdefault(row["range"], []).append((row["g"], row["k"], row["row"]))
    return found


@dataclass(frozen=True)
class Ranges:
    """Where ranges begin, and the rows and bytes of each, in order."""

    splitters: list[Splitter]
    totals: list[tuple[int, int]]


def _totals(rows: DataFrame, splitters: list[Splitter]) -> list:
    counted = rows.withColumn("range", _range_of(splitters)).groupBy("range")
    sums = (F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("g").alias("g0"), F.max("g").alias("g1"))
    keys = (F.min("k").alias("k0"), F.max("k").alias("k1"))
    return counted.agg(*sums, *keys).collect()  # a row per range


def splitters(rows: DataFrame, n_bytes: int, ranges: int, most: int) -> Ranges:
    """Splitters by which no range holds more than twice ``most`` bytes or the even share
    of a range, unless it is one row."""
    share = max(1, n_bytes // ranges)
    found = _sampled(rows.withColumn("range", F.lit(0)), F.lit(share / SAMPLES), False, ranges)
    cuts = sorted({(g, _LEAST, _LEAST) for g, _, _ in found.get(0, [])})
    limit, seen = 2 * max(most, share), set()
    while True:
        totals = _totals(rows, cuts)
        over = {t["range"]: t for t in totals if t["bytes"] > limit and t["n"] > 1}
        begins = {i: cuts[i - 1] if i else (_LEAST, _LEAST, _LEAST) for i in over}
        # a range that a sample of its own did not cut holds nothing but rows that are large themselves
        over = {i: t for i, t in over.items() if (begins[i], t["n"]) not in seen}
        if not over:
            by_range = {t["range"]: (t["n"], t["bytes"]) for t in totals}
            return Ranges(cuts, [by_range.get(i, (0, 0)) for i in range(len(cuts) + 1)])
        seen |= {(begins[i], t["n"]) for i, t in over.items()}
        more: set[Splitter] = set()
        for within in (False, True):
            some = {i: t for i, t in over.items() if (t["g0"] == t["g1"]) == within}
            if not some:
                continue
            numbers = sorted(some)
            parts = max(2, *(-(-some[i]["bytes"] // max(1, limit // 2)) for i in numbers))
            size = F.lit(np.array([some[i]["bytes"] / (parts * SAMPLES) for i in numbers], dtype=np.float64))
            here = rows.withColumn("range", _range_of(cuts)).where(F.col("range").isin(numbers))
            every = F.get(size, F.array_position(F.lit(np.array(numbers, dtype=np.int32)), F.col("range")).cast("int") - 1)
            for at, quantiles in _sampled(here, every, within, parts).items():
                t = some[at]
                for g, k, row in quantiles:
                    # a group that fills a part of its own begins and ends a range
                    new = [(g, k, row)] if within else [(g, _LEAST, _LEAST), (g + 1, _LEAST, _LEAST)]
                    more |= {c for c in new if (t["g0"], _LEAST, _LEAST) < c and c[0] <= t["g1"]}
        cuts = sorted({*cuts, *more})


def shards(
    df: DataFrame,
    key: str = "doc_id",
    size: str = "size",
    group: str = "group",
    n_shards: int = SHARDS,
    whole: int = WHOLE,
) -> DataFrame:
    """Rows (row: the row of ``df``, shard, slot): shards 0 to ``n_shards`` - 1 of about equal
    sums of ``size``, in order of (group, key); slots count from 0 in every shard.

    ``size`` is a column of whole numbers (null or below 1 counts as 1), ``group`` one of
    numbers. Null keys come first in their group, null groups before all others. Rows with
    equal groups and keys are ordered by a row number that is written down first. A group
    larger than the bound above is cut by key, so any share of all rows may be one group, and
    any of those one key. A row that is larger than a shard has one for itself, and others
    may be empty, as they are where there are fewer rows than shards. An empty table has no
    rows. Columns of ``df`` are handed on whole in ``row``, so no name clashes. Runs jobs.
    """
    order = df.select(
        F.struct(*[F.col(c) for c in df.columns]).alias("payload"), F.coalesce(F.col(group).cast("long"), F.lit(_LEAST)).alias("g"),
        _key(df, key).alias("k"), F.greatest(F.coalesce(F.col(size), F.lit(1)), F.lit(1)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = staged(order, "shard-rows")
    n_rows, n_bytes, largest = rows.agg(F.count(F.lit(1)), F.sum("size"), F.max("size")).first()
    if not n_rows:
        return rows.select(F.col("payload").alias("row"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = min(MOST_RANGES, max(n_shards * RANGES_PER_SHARD, -(-n_rows // RANGE_ROWS)))
    most = max(largest, n_bytes // (n_shards * whole))
    cut = splitters(rows, n_bytes, ranges, most)
    # groups with a border inside them: at most one for each splitter
    heavy = sorted({g for g, k, row in cut.splitters if (k, row) != (_LEAST, _LEAST)})

    offsets = np.concatenate([[0], np.cumsum([b for _, b in cut.totals])[:-1]]).astype(np.int64)
    placed = rows.withColumn("range", _range_of(cut.splitters)).withColumn(
        "before", F.get(F.lit(offsets), F.col("range")) if len(offsets) > 1 else F.lit(0).cast("long")
    )
    in_range = Window.partitionBy("range").orderBy("g", "k", "row")
    upto = F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    in_group = Window.partitionBy("range", "g")
    placed = placed.withColumn("at", F.col("before") + upto - F.col("size"))
    placed = placed.withColumns({"group_at": F.min("at").over(in_group), "group_size": F.sum("size").over(in_group)})
    together = ~F.col("g").isin(heavy) & (F.col("group_size") <= most) if heavy else F.col("group_size") <= most
    at, wide = F.when(together, F.col("group_at")).otherwise(F.col("at")), F.when(together, F.col("group_size")).otherwise(F.col("size"))
    # the middle in doubled bytes; a decimal, since the product may exceed a bigint
    middle = (2 * at + wide).cast("decimal(20,0)") * F.lit(n_shards).cast("decimal(10,0)")
    shard = F.floor(middle / F.lit(2 * n_bytes).cast("decimal(20,0)")).cast("int")
    placed = placed.select("payload", "g", "k", "row", "range", shard.alias("shard"))
    placed = staged(few_files(placed, n_rows), "shard-places")

    counts = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))  # shards + ranges rows at most
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("range", "shard").orderBy("g", "k", "row"))
    numbered = placed.withColumn("place", place).join(counts, ["range", "shard"])
    return numbered.select(F.col("payload").alias("row"), "shard", (F.col("first") + F.col("place") - 1).alias("slot"))


def write(placed: DataFrame, folder: str) -> None:
    """Store what ``shards`` returned, a folder per shard, rows in order of their slots. A
    large shard gets several files, of which the earlier ones hold the smaller slots."""
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(folder)


def documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document by the bytes of its text, as equal as they get."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        text_group().alias("group"),
    )
    placed = shards(slim, n_shards=n_shards)
    return placed.select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
