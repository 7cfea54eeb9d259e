"""A Merkle manifest of a table: stored every few levels, proofs from regenerated levels.

Every row is a leaf.  The leaves of one group form a tree (runs of ``FANOUT`` nodes
become their hash until one is left), and the groups' roots form one more tree in
the same way.  Only every ``STRIDE``-th level is written: one row per aligned
subtree of ``FANOUT ** STRIDE`` stored nodes, so a reader needs no shuffle to
regenerate the levels between two stored ones.  Proof extraction goes from the top
down: the path of a stored node meets the subtree below it, the missing interior
nodes are computed again from the stored ones, the siblings of every node are
emitted, and the interior nodes are gone with the row.

All hashes are lower-case hex text of sha256 over inputs joined without a mark.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lintel.session import ensure_checkpoint_dir

FANOUT = 8
STRIDE = 3                 # levels from one stored level to the next
SPAN = FANOUT ** STRIDE    # stored nodes of one aligned subtree


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """One input of a leaf: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, node, lambda acc, x: digest(x["left"], acc, x["right"]))


def siblings_digest(path: Column) -> Column:
    """One hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def _above(nodes: Column) -> Column:
    """The level above an aligned array of digests."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / FANOUT).cast("int") - 1)
    return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(nodes, r * FANOUT + 1, FANOUT), ""), 256))


def _depth() -> Column:
    """Levels that a group's tree still has within this stride."""
    depth = F.lit(STRIDE)
    for d in range(STRIDE - 1, -1, -1):
        depth = F.when(F.col("total") <= FANOUT ** d, F.lit(d)).otherwise(depth)
    return depth


def _regenerated(level: DataFrame) -> DataFrame:
    """Stored subtrees with their interior levels ``l0`` .. ``l<STRIDE>`` computed again."""
    out = level.withColumn("depth", _depth()).withColumn("l0", F.transform("nodes", lambda x: x["digest"]))
    for d in range(STRIDE):
        out = out.withColumn(f"l{d + 1}", _above(F.col(f"l{d}")))
    return out


def _numbered(nodes: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """``nodes`` with ``pos``, the place in its group by ``order``, and ``total``, the group's size.

    Rows are range-partitioned and sorted once and written with a row number that
    only orders rows within a partition; the sizes of the parts of a group before
    each part (at most one row per partition and group) turn it into the place.
    """
    nodes.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order).withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    rows = nodes.sparkSession.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    spans = rows.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    mine = Window.partitionBy("grp")
    before = F.coalesce(F.sum("n").over(mine.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(F.col("part").alias("p"), F.col("grp").alias("g"), "first", before.alias("before"), F.sum("n").over(mine).alias("total"))
    joined = rows.join(spans, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g")))
    return joined.withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop("part", "p", "g", "first", "before", "at")


def _stored(nodes: DataFrame, carried: Sequence[str], path: str) -> DataFrame:
    """Writes one row per aligned subtree: its nodes in order."""
    node = F.struct("pos", "digest", *carried)
    nodes.groupBy("grp", F.floor(F.col("pos") / SPAN).alias("sub")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(node)).alias("nodes")).write.parquet(path)
    return nodes.sparkSession.read.parquet(path)


@dataclass
class Tree:
    """The stored levels of the trees of all groups, from the leaves up, and each group's root."""

    levels: list[str]
    roots: str

    @classmethod
    def build(cls, nodes: DataFrame, order: Sequence[str], carried: Sequence[str], base: str) -> Tree:
        """``nodes``: ``grp``, ``digest``, the ``order`` and the ``carried`` columns (sortable types)."""
        spark = nodes.sparkSession
        placed = _numbered(nodes, order, f"{base}/placed")
        paths = [f"{base}/level-0"]
        level = _stored(placed, carried, paths[0])
        largest = level.agg(F.max("total")).first()[0] or 0
        while True:
            done = _regenerated(level)
            top = F.element_at(F.array(*[F.element_at(f"l{d}", 1) for d in range(STRIDE + 1)]), F.col("depth") + 1)
            above = done.select("grp", F.col("sub").alias("pos"), F.greatest(F.ceil(F.col("total") / SPAN), F.lit(1)).alias("total"), top.alias("digest"))
            largest = -(-largest // SPAN)
            if largest <= 1:
                above.select("grp", "digest").write.parquet(f"{base}/roots")
                return cls(paths, f"{base}/roots")
            paths.append(f"{base}/level-{STRIDE * len(paths)}")
            level = _stored(above, [], paths[-1])

    def paths(self, spark: SparkSession, tops: DataFrame) -> DataFrame:
        """Every leaf with its path; ``tops`` holds ``grp``, ``path`` from each group's root on, and columns to hand down."""
        handed = [c for c in tops.columns if c not in ("grp", "path")]
        up = tops.select(F.col("grp").alias("g"), F.lit(0).cast("long").alias("s"), "path", *handed)
        for at in reversed(self.levels):
            level = _regenerated(spark.read.parquet(at))
            met = level.join(up, F.col("grp").eqNullSafe(F.col("g")) & (F.col("sub") == F.col("s")))
            found = F.transform("nodes", lambda x, i: F.struct(x.alias("node"), F.concat(_siblings(i), F.col("path")).alias("path")))
            up = met.select("grp", *handed, F.inline(found))
            if at != self.levels[0]:
                up = up.select(F.col("grp").alias("g"), F.col("node.pos").alias("s"), "path", *handed)
        return up


def _siblings(i: Column) -> Column:
    """Siblings of the ``i``-th stored node of a subtree, one pair of texts per regenerated level below the subtree's top."""
    none = F.array().cast("array<struct<left:string,right:string>>")
    levels = []
    for d in range(STRIDE):
        at = F.floor(i / FANOUT ** d).cast("int")
        within, nodes = at % FANOUT, F.col(f"l{d}")
        left = F.array_join(F.slice(nodes, at - within + 1, within), "")
        right = F.array_join(F.slice(nodes, at + 2, F.lit(FANOUT - 1) - within), "")
        levels.append(F.when(F.col("depth") > d, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(none))
    return F.concat(*levels)


@dataclass
class Manifest:
    """The group trees and the tree of their roots, kept under one folder."""

    spark: SparkSession
    groups: Tree
    top: Tree
    carried: list[str]

    def root(self) -> DataFrame:
        """One row, ``digest``; none for an empty table."""
        return self.spark.read.parquet(self.top.roots).select("digest")

    def subroots(self) -> DataFrame:
        """``grp, subroot, root, path``: the path leads from the group's root to the root."""
        tops = self.spark.read.parquet(self.top.roots).select("grp", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
        return self.top.paths(self.spark, tops).select(F.col("node.id").alias("grp"), F.col("node.digest").alias("subroot"), "root", "path")

    def proofs(self) -> DataFrame:
        """One row per leaf: ``id, leaf, subroot, root, path`` and the carried columns."""
        return self.groups.paths(self.spark, self.subroots()).select(
            F.col("node.id").alias("id"), F.col("node.digest").alias("leaf"), "subroot", "root", "path", *[F.col(f"node.{c}").alias(c) for c in self.carried])


def build(docs: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "lang", carry: Mapping[str, Column] | None = None,
          store: str | None = None) -> Manifest:
    """Build and store the manifest of ``docs``.

    A leaf is the hash of ``fields`` (``field`` says how each enters).  Leaves of a
    group ascend by ``key``, null first, then by leaf: rows that repeat one key have
    their places by content, and equal rows are interchangeable.  A null group is a
    group of its own and comes first.  Null and empty values differ (``-`` and
    ``0:``).  An empty table has no root and no proofs; a lone leaf is its group's
    root.  ``carry`` names further columns to keep beside each leaf; all others,
    whatever their names, are ignored.  ``store`` is a new folder; by default one in
    the folder of ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    base = store or f"{ensure_checkpoint_dir(spark).rstrip('/')}/merkle-{uuid.uuid4().hex}"
    carry = dict(carry or {})
    leaves = docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("id"), leaf(*[F.col(f"`{f}`") for f in fields]).alias("digest"),
                         *[c.alias(n) for n, c in carry.items()], F.monotonically_increasing_id().alias("row"))
    # Texts are hashed once; the range partitioning samples and sorts this small table.
    leaves.write.parquet(f"{base}/leaves")
    groups = Tree.build(spark.read.parquet(f"{base}/leaves"), ["id", "digest", "row"], ["id", *carry], f"{base}/groups")
    roots = spark.read.parquet(groups.roots).select(F.lit(0).alias("grp"), F.col("grp").alias("id"), "digest")
    return Manifest(spark, groups, Tree.build(roots, ["id"], ["id"], f"{base}/top"), list(carry))
