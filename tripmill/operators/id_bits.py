"""Sets of ids as bitmaps of their hashes, a byte an id, small enough to broadcast.

Every id of the set is found; of the others some are found as well (``false_share``). So rows
that can't be in the set are told apart without a shuffle, and only the rest pays for one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.sources.staging import staged

#: Bits of one of Spark's bitmaps, as a power of two.
_POWER = 15


def bits_for(n_ids: int, most_bytes: int) -> int:
    """Eight bits an id, in whole bitmaps, up to ``most_bytes`` bytes."""
    wanted = max(1, math.ceil(8 * n_ids / 2**_POWER))
    return min(wanted, max(1, 8 * most_bytes >> _POWER)) << _POWER


def false_share(n_ids: int, bits: int) -> float:
    """Share of ids outside the set that are found nevertheless."""
    return 1 - math.exp(-n_ids / bits)


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bitmaps(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """The set of the non-null ``key`` of ``ids``, one row (_bucket, _bitmap) per bitmap. The
    places are shuffled, not partial bitmaps of every task."""
    places = ids.filter(F.col(key).isNotNull()).select(_place(key, bits).alias("_place"))
    dealt = places.withColumn("_bucket", F.shiftright("_place", _POWER)).repartition("_bucket")
    bit = F.col("_place").bitwiseAND(F.lit(2**_POWER - 1))
    return staged(dealt.groupBy("_bucket").agg(F.bitmap_construct_agg(bit).alias("_bitmap")), "id-bits")


def marked(rows: DataFrame, key: str, found: DataFrame, bits: int, name: str) -> DataFrame:
    """Add whether ``key`` may be in the set; false for null."""
    bit = _place(key, bits).bitwiseAND(F.lit(2**_POWER - 1))
    byte = F.conv(F.hex(F.substring("_bitmap", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    maybe = F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1
    dealt = rows.withColumn("_bucket", F.when(F.col(key).isNotNull(), F.shiftright(_place(key, bits), _POWER)))
    held = dealt.join(F.broadcast(found), "_bucket", "left")
    return held.select(*rows.columns, F.coalesce(maybe, F.lit(False)).alias(name))
