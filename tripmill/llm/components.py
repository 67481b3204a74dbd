"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.blocks import few_files
from tripmill.sources.staging import staged


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) of every node of ``links`` (a, b); the root is the smallest node
    that can be reached.

    Large stars and small stars take turns: every node hangs its greater neighbours, then
    its smaller ones, on the least of them, until the links are stars. A round is two
    aggregations and joins on the links; the rounds are few, as paths shorten by half. The
    links of each round are written to the shared folder, which cuts the lineage.
    """
    both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    now = staged(both.distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        # each node with all its neighbours: the greater ones go to the least of all
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # then the smaller neighbours, and the node, go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        # no round has more links than the one before
        now = staged(few_files(small.where("u <> v").distinct(), state[0]), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
