"""Merkle manifest of a dataset, with inclusion proofs from a few stored levels.

Each row is a leaf; the leaves of a tree (one per value of a column) stand in order, and every two consecutive nodes become
the next level's node, a last one alone too, until one is left. Ranges of the order are sorted in one exchange and number
their leaves. Then only every ``step``-th level is stored: an aligned subtree of 2 ** step nodes is folded in one task, its
interior nodes are never kept. The roots of all trees, in the order of the trees' names, are the leaves of one more tree.

A proof regenerates what was not kept: from the top down, each stored level is dealt into its aligned subtrees, every
subtree's missing interior nodes are folded anew from its stored descendants, the siblings on each descendant's way up are
emitted behind those of the levels below it, and the interior nodes are dropped. So 1/2 ** step of all nodes beyond the
leaves is stored, and a proof costs the folding of one subtree per stored level.

A digest is the lower-case hex SHA-256 of text; a node is the digest of its children's hex digests, concatenated. A leaf is
the digest of its fields, each ``-`` if null, else its number of UTF-8 bytes, ``:`` and its value, so that no two rows of
fields have the same text.

Defined cases: nulls stand for themselves in fields, and first in both orders; rows equal in tree and order stand in order of
their digests; repeated rows are leaves of their own; a tree of one leaf is that leaf; texts of any length count whole; an
empty table has no trees and no rows; the result holds the order column, the named extra columns (of types that can be
sorted) and its own, so no other column clashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderflow.llm.common import in_slices
from orderflow.session import materialize

STEP = 6
SIDES = "array<struct<digest:string,left:boolean>>"


def digest(*fields: Column | str) -> Column:
    """The digest of a row of fields, never null."""
    spelled = []
    for field in fields:
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        spelled.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*spelled), 256)


def _above(nodes: Column) -> Column:
    """The next level of an array of digests."""
    last = F.call_function("shiftright", F.size(nodes) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(nodes, 2 * i + 1, 2), ""), 256))


def _up_to(height: str) -> Column:
    """1 to ``height``, empty for 0."""
    return F.when(F.col(height) > 0, F.sequence(F.lit(1), F.greatest(height, F.lit(1)))).otherwise(F.array().cast("array<int>"))


def _interior(nodes: str, height: str) -> Column:
    """Levels 0 to ``height`` of a subtree, regenerated from its lowest."""
    begin = F.array(F.col(nodes))
    return F.aggregate(_up_to(height), begin, lambda levels, _: F.concat(levels, F.array(_above(F.element_at(levels, -1)))))


def _subtrees(level: DataFrame, step: int, *extra: str) -> DataFrame:
    """(_tree, _group, _count, _height, _nodes): the aligned subtrees of a level, at most 2 ** step nodes each, in order.

    The height goes up to the next stored level, or to the root.
    """
    nodes = F.sort_array(F.collect_list(F.struct("_index", "digest", *extra)))  # by _index, which differs in a tree
    grouped = level.groupBy("_tree", F.shiftright("_index", step).alias("_group"))
    grouped = grouped.agg(nodes.alias("_nodes"), F.first("_count").alias("_count"))
    bits = F.length(F.conv((F.col("_count") - 1).cast("string"), 10, 2))
    return grouped.withColumn("_height", F.least(F.lit(step), F.when(F.col("_count") <= 1, 0).otherwise(bits)))


@dataclass
class Forest:
    """Stored levels of a set of trees, lowest first: _tree, _index, _count (nodes of the level in the tree), digest."""

    levels: list[DataFrame]
    step: int

    @property
    def roots(self) -> DataFrame:
        return self.levels[-1].select("_tree", "digest")


def grow(leaves: DataFrame, step: int = STEP) -> Forest:
    """``leaves``: _tree, _index (gapless from 0 in each tree), _count, digest, stored."""
    levels = [leaves]
    while (levels[-1].agg(F.max("_count")).first()[0] or 0) > 1:
        sub = _subtrees(levels[-1], step).withColumn("_digests", F.col("_nodes.digest"))
        sub = sub.withColumn("_levels", _interior("_digests", "_height"))
        top = F.element_at(F.element_at("_levels", -1), 1)
        count = F.call_function("shiftright", F.col("_count") - 1, F.col("_height")) + 1
        above = sub.select("_tree", F.col("_group").alias("_index"), count.alias("_count"), top.alias("digest"))
        levels.append(materialize(above, "merkle-level"))
    return Forest(levels, step)


def _opened(node: Column, names: tuple[str, ...], step: int) -> Column:
    """A descendant with its siblings inside the subtree, followed by the subtree's own way up."""
    inside = node["_index"].bitwiseAND(F.lit((1 << step) - 1)).cast("int")

    def side(level: Column) -> Column:
        at = F.call_function("shiftright", inside, level - 1)
        sibling = F.get(F.element_at("_levels", level), at.bitwiseXOR(F.lit(1)))
        return F.struct(sibling.alias("digest"), (at.bitwiseAND(F.lit(1)) == 1).alias("left"))

    path = F.concat(F.transform(_up_to("_height"), side), F.col("_path"))
    kept = [node[x].alias(x) for x in ("_index", "digest", *names)]
    return F.struct(*kept, path.alias("_path"), F.col("_root").alias("_root"))


def prove(forest: Forest, from_root: DataFrame, *extra: str) -> DataFrame:
    """The leaves with ``extra``, _root and _path: for each level up, the sibling (null for none) and whether it is left.

    ``from_root``: _tree, _root (the tree's own root) and _path, the way on from there.
    """
    way = from_root.select("_tree", F.lit(0).cast("long").alias("_index"), "_path", "_root")
    for depth in reversed(range(len(forest.levels) - 1)):
        names = extra if depth == 0 else ()
        sub = _subtrees(forest.levels[depth], forest.step, *names).withColumn("_digests", F.col("_nodes.digest"))
        met = sub.join(way.withColumnRenamed("_index", "_group"), ["_tree", "_group"])
        # a column of its own: written into the generator, the levels would be folded again for each node
        met = met.withColumn("_levels", _interior("_digests", "_height"))
        way = met.select("_tree", F.inline(F.transform("_nodes", lambda node: _opened(node, names, forest.step))))
        if depth:
            way = materialize(way.select("_tree", "_index", "_path", "_root"), "merkle-paths")
    if len(forest.levels) == 1:
        way = forest.levels[0].join(way, ["_tree", "_index"])
    return way.select("_tree", "digest", *extra, "_root", "_path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""

    def up(node: Column, side: Column) -> Column:
        beside = F.coalesce(side["digest"], F.lit(""))
        return F.sha2(F.when(side["left"], F.concat(beside, node)).otherwise(F.concat(node, beside)), 256)

    return F.aggregate(path, leaf, up)


def numbered(leaves: DataFrame, order: str, name: str) -> DataFrame:
    """Leaves with a gapless ``_index`` in their ``_tree``, by ``order``, and the tree's ``_count``; stored."""
    rows = materialize(leaves.withColumn("_tie", F.monotonically_increasing_id()), f"{name}-leaves")
    sliced = in_slices(rows, [F.col(k) for k in ("_tree", order, "digest", "_tie")], f"{name}-slices")
    counts = sliced.groupBy("_slice", "_tree").agg(F.count("*").alias("_n"))
    tree = W.partitionBy("_tree")  # one row per slice that a tree lies in
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    base = counts.select("_slice", "_tree", before.alias("_before"), F.sum("_n").over(tree).alias("_count"))
    inside = W.partitionBy("_slice", "_tree").orderBy(order, "digest", "_tie")
    placed = sliced.join(base, ["_slice", "_tree"]).withColumn("_index", F.col("_before") + F.row_number().over(inside) - 1)
    return materialize(placed.drop("_slice", "_before", "_tie"), f"{name}-numbered")


def manifest(
    df: DataFrame, fields: list[str], tree: str, order: str, extra: dict[str, Column] | None = None, step: int = STEP
) -> DataFrame:
    """For every row its ``order`` column, ``extra`` columns, leaf, subroot, root, and path (siblings up to the root)."""
    extra = extra or {}
    name = F.when(F.col(tree).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(tree).cast("string")))
    own = [F.col(order).alias("_order"), *(c.alias(f"_of_{k}") for k, c in extra.items())]
    forest = grow(numbered(df.select(name.alias("_tree"), digest(*fields).alias("digest"), *own), "_order", "merkle"), step)
    names = forest.roots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_name"), "digest")
    crown = grow(numbered(names, "_name", "merkle-roots"), step)
    no_way = crown.roots.select("_tree", F.col("digest").alias("_root"), F.array().cast(SIDES).alias("_path"))
    crowned = prove(crown, no_way, "_name").select(F.col("_name").alias("_tree"), F.col("digest").alias("_root"), "_path")
    top = crown.roots.first()  # the root: one row at most
    proofs = prove(forest, crowned, "_order", *(f"_of_{k}" for k in extra))
    return proofs.select(
        F.col("_order").alias(order), *(F.col(f"_of_{k}").alias(k) for k in extra), F.col("digest").alias("leaf"),
        F.col("_root").alias("subroot"), F.lit(top["digest"] if top else None).cast("string").alias("root"),
        F.col("_path").alias("path"),
    )
