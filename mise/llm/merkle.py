"""Merkle dataset manifest: a digest tree of which only every few levels are stored, and proofs that
regenerate the levels between.

Each row is a leaf; the leaves of a group (a source) ascend by id and are hashed in runs of FANOUT,
level by level, to the group's subroot; the subroots, ordered by group, likewise to the root.  Stored
are aligned subtrees: all nodes of one stored level (leaves, then every STRIDE-th level) below one
node of the next stored one, a row of at most FANOUT ** STRIDE digests.  Proof extraction goes down
from the root: for each stored subtree the missing interior nodes are computed again from its nodes,
the siblings of every node on each of these levels are appended to the path of the subtree's own
top, and the interior nodes are dropped.  Joins meet one row with one row (a subtree with its top),
so a group that holds a third of all rows costs as many tasks as it has subtrees.

Positions come from a range partitioning, numbered inside each partition and offset by the counts of
the group's earlier partitions (one row per partition and group), so no task gets a whole group.

Digests are lower-case hex SHA-256, of the inputs' concatenation; inner nodes hash their children's
hex text.  A path is an array of (left, right), from the leaf up: the concatenated siblings on either
side in the run.  A lone node has no run and no step; a run of one node is hashed.

Defined results: a null field is encoded as ``-``, so it differs from the empty string; the null group
is a group of its own, first; rows with a null id come first in their group; equal ids are ordered by
their leaves, and equal leaves may swap, which changes no digest; repeated rows are leaves each; an
empty table has no groups and gives empty results; other columns than those asked for are never read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, let

FANOUT = 16
#: Levels from one stored level to the next.
STRIDE = 2
PATH = "array<struct<left:string,right:string>>"


# --------------------------------------------------------------------------------------- digests
def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return hashed(*[encoded(f) for f in fields])


def _level_up(nodes: Column, fanout: int, alone: Column) -> Column:
    """The next level's digests; the lone node of a whole group stays as it is."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int")),
                       lambda i: F.sha2(F.array_join(F.slice(nodes, i * fanout + 1, fanout), ""), 256))
    return F.when(alone & (F.size(nodes) == 1), nodes).otherwise(runs)


def _with_levels(nodes: Column, steps: int, fanout: int, alone: Column, body: Callable[[list[Column]], Column]) -> Column:
    """``body`` of the ``steps`` + 1 levels from ``nodes`` up, each computed once."""
    def climb(levels: list[Column]) -> Column:
        if len(levels) > steps:
            return body(levels)
        return let(_level_up(levels[-1], fanout, alone), lambda up: climb([*levels, up]))

    return let(nodes, lambda first: climb([first]))


# ------------------------------------------------------------------------------------------ tree
@dataclass
class Tree:
    """Stored levels, lowest first: tables of grp, block, n (the group's nodes on this level) and nodes
    (array of digest and what the leaves carry); and the groups' tops: grp, level, subroot."""

    levels: list[DataFrame]
    tops: DataFrame
    fanout: int
    stride: int


def numbered(scratch: Scratch, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with pos, their place in their ``grp`` by ``order`` from 0, and n, the group's size."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The last key parts rows that are equal otherwise.
    keys = ["grp", *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ranged = scratch.table(ranged.drop("_tie").withColumn("_i", F.monotonically_increasing_id())
                           .withColumn("_part", F.shiftright("_i", 33)))
    runs = ranged.groupBy("grp", "_part").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # A group has one row for each partition here.
    earlier = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("grp", "_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
                       F.sum("_rows").over(Window.partitionBy("grp")).alias("n"))
    found = ranged.join(runs, ["grp", "_part"])
    return found.withColumn("pos", F.col("_i") - F.col("_first") + F.col("_before")).drop("_i", "_part", "_first", "_before")


def build(scratch: Scratch, leaves: DataFrame, order: Sequence[str], fanout: int = FANOUT, stride: int = STRIDE) -> Tree:
    """The tree of each ``grp`` over rows of grp (not null), digest, the columns of ``order`` and any others, which
    are carried with the leaves."""
    if fanout < 2 or stride < 1:
        raise ValueError("the fan-out is 2 or more and the stride 1 or more")
    span = fanout ** stride
    carried = [c for c in leaves.columns if c != "grp"]
    rows, levels, tops = numbered(scratch, leaves, [*order, "digest"]), [], []
    while True:
        node = F.struct("pos", *carried)
        blocks = rows.groupBy("grp", F.floor(F.col("pos") / span).cast("long").alias("block"), "n").agg(
            F.sort_array(F.collect_list(node)).alias("nodes"))
        # Sorted by place, which then follows from the index.
        blocks = blocks.withColumn("nodes", F.transform("nodes", lambda x: F.struct(*[x[c].alias(c) for c in carried])))
        blocks = scratch.table(blocks)
        digests = F.transform("nodes", lambda x: x["digest"])
        alone = F.col("n") <= span
        top = _with_levels(digests, stride, fanout, alone, lambda ls: F.element_at(ls[-1], 1))
        above = scratch.table(blocks.select("grp", "block", "n", top.alias("digest")))
        levels.append(blocks)
        tops.append(above.where(alone).select("grp", F.lit(len(levels) - 1).alias("level"), F.col("digest").alias("subroot")))
        rest = above.where(~alone)
        if not rest.take(1):
            break
        rows = rest.select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / span).cast("long").alias("n"), "digest")
        carried = ["digest"]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return Tree(levels, out, fanout, stride)


def paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """One row per leaf: grp, what the leaves carry, path, and the further columns of ``tops`` (grp, level, path and any
    others), whose paths lead on from the groups' subroots."""
    span, fanout = tree.fanout ** tree.stride, tree.fanout
    passed = [c for c in tops.columns if c not in ("grp", "level", "path")]

    def siblings(level: Column, i: Column, alone: Column) -> Column:
        run = i - i % fanout
        left = F.array_join(F.slice(level, run + 1, i - run), "")
        right = F.array_join(F.slice(level, i + 2, run + fanout - i - 1), "")
        return F.when(~alone | (F.size(level) > 1), F.struct(left.alias("left"), right.alias("right")))

    def expanded(levels: list[Column], fields: Sequence[str], alone: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            steps = [siblings(level, F.floor(i / fanout ** k).cast("int"), alone) for k, level in enumerate(levels[:-1])]
            return F.struct(*[x[c].alias(c) for c in fields], i.alias("_at"),
                            F.concat(F.filter(F.array(*steps), lambda s: s.isNotNull()), F.col("path")).alias("path"))

        return F.transform("nodes", one)

    found = None
    for k in range(len(tree.levels) - 1, -1, -1):
        parents = tops.where(F.col("level") == k).select("grp", F.lit(0).cast("long").alias("block"), "path", *passed)
        if found is not None:
            parents = parents.unionByName(found.select("grp", F.col("pos").alias("block"), "path", *passed))
        blocks = tree.levels[k].join(parents, ["grp", "block"])
        fields = blocks.schema["nodes"].dataType.elementType.names
        alone = F.col("n") <= span
        below = _with_levels(F.transform("nodes", lambda x: x["digest"]), tree.stride, fanout, alone,
                             lambda ls, fields=fields, alone=alone: expanded(ls, fields, alone))
        found = blocks.select("grp", "block", *passed, F.explode(below).alias("_x"))
        found = found.select("grp", *passed, (F.col("block") * span + F.col("_x._at")).alias("pos"), "_x.path",
                             *[F.col(f"_x.{c}") for c in fields])
    return found.drop("pos")


# -------------------------------------------------------------------------------------- manifest
@dataclass
class Manifest:
    """A tree over the groups' leaves, one over the groups' subroots, and the group's value by its key."""

    leaves: Tree
    roots: Tree


def group_key(group: Column) -> Column:
    """A key that is never null and sorts as the group, null first, does by its UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def manifest(docs: DataFrame, fields: Sequence[str], group_col: str = "source", id_col: str = "doc_id",
             carry: Mapping[str, Column] | None = None, fanout: int = FANOUT, stride: int = STRIDE) -> Manifest:
    """The manifest of a table whose rows are hashed over ``fields``.  ``carry`` names further values of a row that
    are stored with its leaf (small ones: they are no part of any digest)."""
    carry = dict(carry or {})
    clash = {"grp", "pos", "n", "digest", "id", "path", "subroot", "root"} & set(carry)
    if clash:
        raise ValueError(f"carried columns need other names than {sorted(clash)}")
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table(docs.select(group_key(F.col(group_col)).alias("grp"), F.col(id_col).alias("id"),
                                     leaf_digest([F.col(f) for f in fields]).alias("digest"),
                                     *[c.alias(name) for name, c in carry.items()]))
    leaves = build(scratch, rows, ["id"], fanout, stride)
    tops = leaves.tops.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "level", F.col("subroot").alias("digest"))
    return Manifest(leaves, build(scratch, tops.withColumnRenamed("level", "member_level"), ["member"], fanout, stride))


def root(m: Manifest) -> DataFrame:
    """The one root (no row for an empty table)."""
    return m.roots.tops.select(F.col("subroot").alias("root"))


def subroots(m: Manifest) -> DataFrame:
    """One row per group: the group's value and its subroot."""
    return m.leaves.tops.select(F.expr("CASE WHEN grp != '' THEN substr(grp, 2) END").alias("group"), "subroot")


def proofs(m: Manifest) -> DataFrame:
    """One row per leaf: group, id, leaf, what was carried, subroot, root and path (array of left, right)."""
    empty = F.array().cast(PATH)
    tops = paths(m.roots, m.roots.tops.select("grp", "level", empty.alias("path"), F.col("subroot").alias("root")))
    tops = tops.select(F.col("member").alias("grp"), F.col("member_level").alias("level"), "path", "root",
                       F.col("digest").alias("subroot"))
    found = paths(m.leaves, tops).withColumnRenamed("digest", "leaf")
    group = F.expr("CASE WHEN grp != '' THEN substr(grp, 2) END").alias("group")
    carried = [c for c in found.columns if c not in ("grp", "id", "leaf", "subroot", "root", "path")]
    return found.select(group, "id", "leaf", *carried, "subroot", "root", "path")


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, in its order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, s: hashed(s["left"], node, s["right"]))
