"""Deduplication on the trip id: the newest copy gets rank 1."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripmill.functions.columns import row_hash
from tripmill.operators import id_bits
from tripmill.operators.ordered import running_total
from tripmill.schema import DUPLICATE_RANK
from tripmill.sources.staging import staged

NEWEST_FIRST = ("trip_end_timestamp", "trip_start_timestamp", "trip_total")


@dataclass(frozen=True)
class CopyPolicy:
    """How the copies of an id are brought together. Changes the cost, never a result."""

    # Ids with at least this many rows are ranked in slices instead of one task.
    hot_rows: int = 1_000_000
    # A list of ids is broadcast up to this many ids and bytes of text.
    broadcast_ids: int = 500_000
    broadcast_bytes: int = 32 * 1024 * 1024
    # Copies are picked out of the rows, for a second scan, up to this share of them.
    copy_share: float = 0.25
    # The rows are stored: reading them once more costs a scan. Then rows whose id can't be a
    # repeated one are told by a bitmap, if no more than ``most_shuffled`` of all are left.
    stored: bool = False
    most_shuffled: float = 0.75

    def fits(self, ids: int, size: int) -> bool:
        return ids <= self.broadcast_ids and size <= self.broadcast_bytes


def newest_first(df: DataFrame, tie_break: tuple[str, ...] | None = None) -> list[Column]:
    """Total order of the copies of one id: newest first, nulls last.

    Copies that agree on the three trip columns are ordered by ``tie_break``, and in the
    end by a hash of every hashable column, so that reruns choose the same copy.
    """
    order = [F.col(c).desc_nulls_last() for c in (*NEWEST_FIRST, *(tie_break or ()))]
    return order + [row_hash(df.schema).desc()]


@dataclass(frozen=True)
class Copies:
    """The ids that occur more than once (``trip_id``, ``n``) and how many there are."""

    ids: DataFrame
    n_rows: int  # rows of all ids, repeated or not
    n_ids: int
    n_copies: int
    size: int
    n_hot: int
    hot_size: int


def copies_of(df: DataFrame, key: str = "trip_id", policy: CopyPolicy = CopyPolicy()) -> Copies:
    """Find the repeated ids of ``df`` in one job.

    Reads and shuffles the id column only, after a count inside each map task. The ids
    are staged, since several branches of the plan read them; their numbers are seen
    during that write, in its last stage, where a repeated task counts once.
    """
    is_hot, size = F.col("n") >= policy.hot_rows, F.octet_length(key)
    every, repeated = Observation(), Observation()
    counts = df.groupBy(key).agg(F.count("*").alias("n")).observe(every, F.sum("n").alias("n_rows"))
    repeats = counts.filter(F.col("n") > 1).observe(
        repeated,
        F.count(F.lit(1)).alias("n_ids"),
        F.sum("n").alias("n_copies"),
        F.sum(size).alias("size"),
        F.count_if(is_hot).alias("n_hot"),
        F.sum(F.when(is_hot, size)).alias("hot_size"),
    )
    ids = staged(repeats, "repeated-ids")
    seen = {**every.get, **repeated.get}
    return Copies(ids, **{f.name: seen.get(f.name) or 0 for f in fields(Copies) if f.name != "ids"})


def ranked(
    df: DataFrame,
    key: str = "trip_id",
    tie_break: tuple[str, ...] | None = None,
    policy: CopyPolicy = CopyPolicy(),
    rank: str = DUPLICATE_RANK,
) -> DataFrame:
    """Add the rank of each row among the copies of its id, 1 for the newest.

    The ids are counted first. Where those that repeat are few, only their rows are
    shuffled and all others get rank 1 on the spot; of stored rows those that a bitmap of
    the repeated ids leaves; otherwise every row is shuffled by id. Ids with very many rows are ranked in slices. Rows without an id have no copies:
    they get no rank and pass by the shuffle. The count runs when this is called.
    """
    order = newest_first(df, tie_break)
    without_id = df.filter(F.col(key).isNull()).withColumn(rank, F.lit(None).cast("bigint"))
    with_id = df.filter(F.col(key).isNotNull())
    copies = copies_of(with_id, key, policy)

    def rows_of(ids: DataFrame, how: str, fits: bool, rows: DataFrame = with_id) -> DataFrame:
        ids = ids.select(key)
        return rows.join(F.broadcast(ids) if fits else ids, key, how).select(df.columns)

    hot, light = (copies.ids.filter(c) for c in (F.col("n") >= policy.hot_rows, F.col("n") < policy.hot_rows))
    hot_fits = policy.fits(copies.n_hot, copies.hot_size)
    few = policy.fits(copies.n_ids, copies.size) and copies.n_copies <= policy.copy_share * copies.n_rows

    parts = [without_id]
    if few:
        single = rows_of(copies.ids, "left_anti", True) if copies.n_ids else with_id
        parts.append(single.withColumn(rank, F.lit(1).cast("bigint")))
        if copies.n_ids > copies.n_hot:
            parts.append(_ranked_by_window(rows_of(light, "left_semi", True), key, order, rank))
    else:
        rest = with_id
        bits = id_bits.bits_for(copies.n_ids, policy.broadcast_bytes)
        left = copies.n_copies + (copies.n_rows - copies.n_copies) * id_bits.false_share(copies.n_ids, bits)
        if policy.stored and left <= policy.most_shuffled * copies.n_rows:
            told = id_bits.marked(with_id, key, id_bits.bitmaps(copies.ids, key, bits), bits, "_maybe")
            parts.append(told.filter(~F.col("_maybe")).drop("_maybe").withColumn(rank, F.lit(1).cast("bigint")))
            rest = told.filter("_maybe").drop("_maybe")
        rest = rows_of(hot, "left_anti", hot_fits, rest) if copies.n_hot else rest
        parts.append(_ranked_by_window(rest, key, order, rank))
    if copies.n_hot:
        parts.append(_ranked_in_slices(rows_of(hot, "left_semi", hot_fits), key, order, rank))
    return reduce(DataFrame.unionByName, parts)


def _ranked_by_window(df: DataFrame, key: str, order: list[Column], rank: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn(rank, place.cast("bigint"))


def _ranked_in_slices(df: DataFrame, key: str, order: list[Column], rank: str) -> DataFrame:
    # Identical copies tie on every column, so each row gets a number of its own. The
    # numbers are written down before any shuffle: a recomputed task cannot hand out
    # other ones.
    numbered = staged(df.withColumn("_row", F.monotonically_increasing_id()), "hot-ids")
    return running_total(numbered, [key], [*order, F.col("_row").asc()], F.lit(1), rank).drop("_row")


def latest(df: DataFrame, key: str = "trip_id", tie_break: tuple[str, ...] | None = None) -> DataFrame:
    """Only the newest copy of each id; rows without an id are left out.

    Filtering on rank 1 lets Spark keep one row per id in every map task before the
    shuffle, so an id with any number of copies is no hot spot.
    """
    order = newest_first(df, tie_break)
    with_id = df.filter(F.col(key).isNotNull())
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return with_id.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
