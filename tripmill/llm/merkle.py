"""Merkle manifest of a table: leaves by group, nodes with nested intervals, proofs.

Every row is a leaf. The leaves of a group are ordered by key; ``FAN_OUT`` consecutive nodes
become one of the next level until a single node, the group's subroot, is left. The subroots,
ordered by group, form a tree of their own, up to the root of the table.

A node is labelled with the interval ``[lo, hi)`` of the ranks of the leaves below it.
Intervals are nested, so ancestors are found by containment: level by level, nodes join
those of the next level in the bucket (a stretch of ``FAN_OUT ** level`` leaves) that hold their interval.
A parent carries the labelled run of its children, and the siblings of a node are what is
left of the run without the node's own interval.

Texts are read once, for digests. What is sorted, joined and written has some hundred bytes
a row, and a group of any size is spread by rank. Levels are written to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.blocks import few_files
from tripmill.sources.staging import staged

FAN_OUT = 16
#: What a leaf of ``documents`` covers, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sized(column: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """Digest of a row, as bytes. The sizes keep the values apart, whatever they hold."""
    return F.unhex(F.sha2(F.concat(*[sized(c) for c in columns]).cast("binary"), 256))


def text_of(digest: Column) -> Column:
    """Digests, or several in a row, as lower-case hex text."""
    return F.lower(F.hex(digest))


def _parent_digest(below: Column) -> Column:
    return F.unhex(F.sha2(text_of(below).cast("binary"), 256))


@dataclass(frozen=True)
class Tree:
    """Nodes by level, each a written table (grp, lo, hi, n, digest) of ``n`` leaves in the
    group; above the leaves with ``run``, the children as (lo, hi, digest) in order."""

    levels: list[DataFrame]
    fan_out: int

    def tops(self) -> DataFrame:
        """Rows (grp, digest): the last node of each group."""
        tops = [nodes.where(_is_top(F.col("n"), level, self.fan_out)) for level, nodes in enumerate(self.levels)]
        found = tops[0].select("grp", "digest")
        for more in tops[1:]:
            found = found.unionByName(more.select("grp", "digest"))
        return found


def _is_top(n: Column, level: int, fan_out: int) -> Column:
    """Whether ``n`` leaves have one node at this level, and more than one below."""
    here = n <= F.lit(fan_out**level)
    return here if level == 0 else here & (n > F.lit(fan_out ** (level - 1)))


def _bucket(span: int) -> Column:
    """Where the stretch of ``span`` leaves begins that holds a node."""
    return F.col("lo") - F.pmod("lo", F.lit(span).cast("long"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``lo``, the rank within ``grp`` by ``order``, ``hi``, and ``n``, the size
    of the group. ``order`` has to be total. Written once.

    A range partitioning cuts large groups into slices; ranks within a slice are shifted by
    the rows of the slices before it, so no group is sorted in one task.
    """
    by = ["grp", *order]
    cut = rows.repartitionByRange(*by).withColumn("slice", F.spark_partition_id())
    cut = staged(cut, "merkle-slices")
    # a row per group and slice, which is groups + slices rows at most
    sizes = cut.groupBy("grp", "slice").agg(F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("rows").over(group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("grp", "slice", before.alias("before"), F.sum("rows").over(group).alias("n"))
    place = F.row_number().over(Window.partitionBy("grp", "slice").orderBy(*order))
    placed = cut.withColumn("place", place).join(shifts, ["grp", "slice"])
    lo = F.col("before") + F.col("place") - 1
    placed = placed.withColumns({"lo": lo, "hi": lo + 1}).drop("before", "place", "slice")
    return staged(few_files(placed, cut.count()), "merkle-ranks")


def tree(leaves: DataFrame, fan_out: int = FAN_OUT) -> Tree:
    """All levels over ``leaves`` (grp, lo, hi, n, digest), as many as the largest group needs."""
    levels = [leaves]
    rows, groups, most = leaves.agg(F.count(F.lit(1)), F.count_if(F.col("lo") == 0), F.coalesce(F.max("n"), F.lit(0))).first()
    while fan_out ** (len(levels) - 1) < most:
        level = len(levels)
        below = levels[-1].where(F.col("n") > F.lit(fan_out ** (level - 1)))
        bucket = _bucket(fan_out**level).alias("bucket")
        run = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))  # fan_out at most
        nodes = below.groupBy("grp", bucket).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("n").alias("n"), run.alias("run")
        )
        digest = _parent_digest(_joined(F.col("run")))
        nodes = nodes.drop("bucket").withColumn("digest", digest)
        levels.append(staged(few_files(nodes, rows // fan_out**level + groups), "merkle-level"))
    return Tree(levels, fan_out)


def _joined(run: Column) -> Column:
    """The digests of a run, one after another."""
    return F.aggregate(run, F.lit(b""), lambda all_, node: F.concat(all_, node["digest"]))


def siblings(run: Column, lo: Column, hi: Column) -> Column:
    """What ``run`` covers besides the interval: the digests before it and those after it."""
    return F.struct(
        _joined(F.filter(run, lambda node: node["hi"] <= lo)).alias("left"),
        _joined(F.filter(run, lambda node: node["lo"] >= hi)).alias("right"),
    )


def paths(made: Tree, above: DataFrame) -> DataFrame:
    """The leaves with ``up``: for each ancestor from the lowest, the siblings on the way.

    ``above`` has rows (grp, up) with what follows the top of each group, and other columns
    that are handed down as they are. From the top level down, each node joins the parent
    that contains its interval and takes over its path.
    """
    parents, found = None, None
    carried = [c for c in above.columns if c not in ("grp", "up")]
    for level in range(len(made.levels) - 1, -1, -1):
        nodes = made.levels[level]
        top = _is_top(F.col("n"), level, made.fan_out)
        found = nodes.where(top).join(above, "grp")
        if parents is not None:
            span = made.fan_out ** (level + 1)
            children = nodes.where(F.col("n") > F.lit(made.fan_out**level)).withColumn("bucket", _bucket(span))
            holders = parents.select(
                "grp", _bucket(span).alias("bucket"), F.col("lo").alias("from"), F.col("hi").alias("to"),
                F.col("run").alias("siblings"), F.col("up").alias("rest"), *carried,
            )
            inside = (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
            step = siblings(F.col("siblings"), F.col("lo"), F.col("hi"))
            up = F.concat(F.array(step), F.col("rest"))
            held = children.join(holders, ["grp", "bucket"]).where(inside).withColumn("up", up)
            found = found.unionByName(held.select(*found.columns))
        parents = found
    return found


def fold(digest: Column, up: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(up, digest, lambda d, step: _parent_digest(F.concat(step["left"], d, step["right"])))


def proof(up: Column) -> Column:
    """All siblings' digests as hex text, level by level, left to right."""
    return F.array_join(F.transform(up, lambda step: text_of(F.concat(step["left"], step["right"]))), "")


def manifest(
    df: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    columns: tuple[str, ...] = COLUMNS,
    also: dict[str, Column] | None = None,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Rows (key, group, lo, hi, leaf, subroot, root, up): every leaf's place in the tree.

    Digests are bytes; ``up`` is the path to the root for ``fold`` and ``proof``. ``also`` adds
    columns that are computed from the rows of ``df`` while they are read.

    Nulls: the null group is the first group, null keys come first in their group. A null
    value of a covered column is a leaf of its own kind, unlike an empty one. Rows with equal
    keys are ordered by leaf; rows that agree in all covered columns are leaves of their own
    next to each other, in the order in which they were read. Texts are hashed whole,
    whatever their length. An empty table has no rows and no root. Other columns are not
    looked at and may have any name. Runs jobs.
    """
    also = also or {}
    # the prefix keeps null apart from empty and first; Spark compares strings bytewise
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    extra = F.struct(*[c.alias(n) for n, c in also.items()]) if also else F.lit(None)
    leaves = df.select(
        name.alias("grp"), F.col(key).alias("key"), F.col(group).alias("group"), leaf([F.col(c) for c in columns]).alias("digest"),
        extra.alias("also"), F.monotonically_increasing_id().alias("row"),
    )
    # written before any shuffle: texts are read once, and a repeated task can't number anew
    leaves = ranked(staged(leaves, "merkle-leaves"), ["key", "digest", "row"])
    made = tree(leaves, fan_out)
    subroots = made.tops().select("grp", F.col("digest").alias("subroot"))
    n_groups = subroots.count()

    over = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("subroot").alias("digest"))
    over = tree(ranked(over, ["name"]), fan_out)
    roots = over.tops().select(F.col("digest").alias("root"), F.lit("").alias("grp"))
    step = F.struct(F.lit(b"").alias("left"), F.lit(b"").alias("right"))
    ends = roots.withColumn("up", F.filter(F.array(step), lambda _: F.lit(False)))
    tops = paths(over, ends).select(F.col("name").alias("grp"), "root", "up", F.col("digest").alias("subroot"))
    tops = staged(few_files(tops, n_groups), "merkle-tops")

    placed = paths(made, tops).select(
        F.col("key").alias(key), F.col("group").alias(group), "lo", "hi", F.col("digest").alias("leaf"), "subroot", "root", "up",
        *[F.col("also")[n].alias(n) for n in also],
    )
    return placed


def tampered(columns: tuple[str, ...] = COLUMNS, key: str = "doc_id", text: str = "text") -> Column:
    """Leaf of the row as it is after tampering: where 5 divides the CRC of the key, the
    letters A-Z of its text are lower-cased."""
    hit = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = leaf([F.translate(c, upper, lower) if c == text else F.col(c) for c in columns])
    return F.when(hit, changed)


def verified(df: DataFrame) -> DataFrame:
    """Every document's leaf, roots and proof, and whether the root still follows after the
    texts have been tampered with (see ``tampered``), as hex text."""
    rows = manifest(df, also={"altered": tampered()})
    folded = fold(F.coalesce("altered", "leaf"), F.col("up"))
    rows = rows.withColumn("folded", folded)
    return rows.select(
        "doc_id", *[text_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(proof(F.col("up")).cast("binary"), 256).alias("proof_sha256"),
        text_of(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
        F.col("lo").alias("place"),
    )
