"""Merkle manifest of a dataset by concatenated-level strings.

Rows are leaves. The leaves of a group, in order, are cut into aligned blocks
of ``FANOUT ** 2`` nodes, and a block keeps each of its levels as one string of
fixed-width hex digests: a parent is the digest of a ``FANOUT * WIDTH``
character substring, and the siblings of a node are the two substrings that
flank it in its run. What a block comes to is a node of the next tier, which is
cut into blocks in the same way, until a group is one node; the groups' nodes,
in the order of their names, are the leaves of one more tree.

All work is DataFrame expressions. A block holds at most ``FANOUT ** 2`` rows
however large its group is, places in a group come from range partitions and
their counts, and every tier is written to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import even_parts, staged

FANOUT = 16
WIDTH = 64  # hex digits of a digest
BLOCK = FANOUT * FANOUT
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """``-`` if null, else the value's UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    """Digest of a row: of its fields' encodings, one behind the other."""
    return F.sha2(F.concat(*map(field, values)), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def _pieces(level: Column) -> Column:
    """The runs of siblings of a level, as strings."""
    size = FANOUT * WIDTH
    numbers = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / size).cast("int"))
    return F.transform(numbers, lambda r: F.substring(level, r * size + 1, F.lit(size)))


def _parents(level: Column) -> Column:
    """The level above: the digests of its runs."""
    return F.array_join(F.transform(_pieces(level), lambda run: F.sha2(run, 256)), "")


def _flanks(run: Column, place: Column) -> Column:
    """The digests before and behind that at ``place`` (from 0) of a run."""
    return F.struct(F.substring(run, F.lit(1), place * WIDTH).alias("before"),
                    F.substring(run, (place + 1) * WIDTH + 1, F.lit(FANOUT * WIDTH)).alias("after"))


@dataclass
class Tier:
    """``blocks(grp, block, size, items, level0, level1, hash)``: ``size`` counts the
    nodes that the group has in this tier, ``items`` are the block's nodes in order."""

    blocks: DataFrame

    @classmethod
    def of(cls, nodes: DataFrame, name: str) -> Tier:
        """``nodes(grp, pos, size, hash, row)`` cut into blocks."""
        block = F.floor(F.col("pos") / BLOCK).alias("block")
        rows = nodes.groupBy("grp", block).agg(
            F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("pos", "hash", "row"))).alias("items"))
        rows = rows.withColumn("level0", F.array_join(F.col("items.hash"), ""))
        rows = rows.withColumn("level1", F.when(F.col("size") > 1, _parents(F.col("level0"))))
        top = F.when(F.col("size") > FANOUT, F.sha2("level1", 256)).otherwise(F.coalesce("level1", "level0"))
        return cls(staged(rows.withColumn("hash", top), name))

    def open(self) -> DataFrame:
        """Blocks of groups that need another tier."""
        return self.blocks.where(F.col("size") > BLOCK)

    def closed(self) -> DataFrame:
        """``(grp, hash)`` of the groups that this tier brings to one node."""
        return self.blocks.where(F.col("size") <= BLOCK).select("grp", "hash")

    def nodes(self) -> DataFrame:
        """The blocks as nodes of the next tier."""
        return self.open().select("grp", F.col("block").alias("pos"), F.ceil(F.col("size") / BLOCK).alias("size"), "hash",
                                  F.struct(F.col("block")).alias("row"))

    def descend(self, above: DataFrame) -> DataFrame:
        """``above(grp, block, subroot, root, path)`` of the blocks -> the same of their items,
        with ``row`` and ``hash`` in place of ``block``."""
        runs = _pieces(F.col("level0"))
        each = F.transform(runs, lambda run, r: F.struct(
            run.alias("run"), F.slice(F.col("items"), r * FANOUT + 1, F.lit(FANOUT)).alias("items")))
        blocks = self.blocks.select("grp", "block", "size", "level1", each.alias("each")).join(above, ["grp", "block"])
        keep = ["grp", "size", "level1", "subroot", "root", "path"]
        run = blocks.select(*keep, F.posexplode("each").alias("r", "each"))
        item = run.select(*keep, "r", F.col("each.run").alias("run"), F.posexplode("each.items").alias("place", "item"))
        nothing = F.array().cast("array<struct<before:string,after:string>>")
        lower = F.when(F.col("size") > 1, F.array(_flanks(F.col("run"), F.col("place")))).otherwise(nothing)
        upper = F.when(F.col("size") > FANOUT, F.array(_flanks(F.col("level1"), F.col("r")))).otherwise(nothing)
        return item.select("grp", F.col("item.row").alias("row"), F.col("item.hash").alias("hash"), "subroot", "root",
                           F.concat(lower, upper, "path").alias("path"))


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows(grp, hash, row, order...)`` with ``pos``, the place in the group (from 0), and the
    group's ``size``. Ranges of (group, order) hold about as many rows each, whatever a group has."""
    rows = staged(rows.withColumn("tie", F.monotonically_increasing_id()), name)
    keys = ["grp", *order, "tie"]
    spread = staged(rows.repartitionByRange(even_parts(rows), *keys).sortWithinPartitions(*keys)
                    .withColumn("at", F.monotonically_increasing_id()).drop("tie"), name)
    part = F.shiftright("at", 33)  # the number of the partition
    runs = spread.groupBy("grp", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy("grp")
    before = F.sum("n").over(group.orderBy("part")) - F.col("n")
    runs = runs.select("grp", "part", "first", before.alias("before"), F.sum("n").over(group).alias("size"))
    return spread.withColumn("part", part).join(runs, ["grp", "part"]) \
        .select("grp", "hash", "row", "size", (F.col("at") - F.col("first") + F.col("before")).alias("pos"))


def _tree(nodes: DataFrame, name: str, outer=None) -> DataFrame:
    """``nodes(grp, pos, size, hash, row)`` -> ``(row, hash, subroot, root, path)``. ``outer`` gives
    ``(grp, subroot, root, path)`` for the groups' own nodes; without it a group's node is its root."""
    tiers = [Tier.of(nodes, name)]
    while not tiers[-1].open().isEmpty():
        tiers.append(Tier.of(tiers[-1].nodes(), name))
    ends = [t.closed() for t in tiers]
    if outer is None:
        nothing = F.array().cast("array<struct<before:string,after:string>>")
        tops = [e.select("grp", F.col("hash").alias("subroot"), F.col("hash").alias("root"), nothing.alias("path")) for e in ends]
    else:
        every = ends[0]
        for e in ends[1:]:
            every = every.unionByName(e)
        known = outer(every)
        tops = [known.join(e.select("grp"), "grp") for e in ends]
    below = None
    for tier, top in reversed(list(zip(tiers, tops))):
        above = top.select("grp", F.lit(0).cast("long").alias("block"), "subroot", "root", "path")
        if below is not None:
            above = above.unionByName(below.select("grp", F.col("row.block").alias("block"), "subroot", "root", "path"))
        below = tier.descend(above)
        if tier is not tiers[0]:
            below = staged(below, name)
    return below


def manifest(rows: DataFrame, group: str, order: list[str], leaf: Column, keep: list) -> DataFrame:
    """Leaves, roots and sibling paths of all rows of a dataset.

    Groups are values of the text column ``group`` (null is a group of its own, the first; the
    others follow by UTF-8 bytes). Leaves ascend by ``order``, nulls first; rows that tie there
    come by their digest, so repeated rows give one defined tree. While a group has several
    nodes, runs of ``FANOUT`` become the digest of their concatenation, a last run of one too.
    Returns the columns ``keep`` (names or expressions) and ``leaf``, ``subroot``, ``root`` and
    ``path``, an array of ``(before, after)`` from the leaf's run to the root's, where each is
    the concatenated digests of that side's siblings. No rows give no rows; columns that are not
    named are not read. ``keep`` may have any names but these four.
    """
    grp = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = rows.select(grp.alias("grp"), leaf.alias("hash"), F.struct(*keep).alias("row"), F.struct(*order).alias("key"))

    def outer(ends: DataFrame) -> DataFrame:
        tops = ends.select(F.lit("").alias("grp"), "hash", F.struct("grp").alias("row"), F.struct("grp").alias("key"))
        tree = _tree(_placed(tops, ["key"], "merkle-groups"), "merkle-top")
        return staged(tree.select(F.col("row.grp").alias("grp"), F.col("hash").alias("subroot"), "root", "path"), "merkle-tops")

    tree = _tree(_placed(leaves, ["key", "hash"], "merkle-leaves"), "merkle-tier", outer)
    return tree.select("row.*", F.col("hash").alias("leaf"), "subroot", "root", "path")


def lowered(text: Column) -> Column:
    """A text with its A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)
