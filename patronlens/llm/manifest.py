"""Merkle manifest of a table: a digest per row, one root, and a proof for every row.

A row's leaf is the SHA-256 of its fields, each written as ``-`` for a null or as byte count,
colon and value. The leaves of a group (a language) ascend by the order column; every two
consecutive nodes become one, a single last node alone becomes its own digest, until one node,
the group's subroot, remains. Subroots, nulls first and then in the byte order of the group's
value, form a tree of the same kind, whose last node is the root.

The work is cut into superblocks of ``2 ** levels`` consecutive nodes. On the way up every
superblock reduces to one node, which is a node of the next round; rounds end when each tree
has one node. On the way down the nodes of a superblock are cogrouped with the outer nodes
that its proofs need, which are the same for all of them: one row per superblock. The last
such exchange has the leaves on one side: it reduces them again, joins inner and outer part
of each proof and folds the leaf along it, in one ``applyInPandas``. No task holds more than one superblock
and one proof, however large a group is.

Null and empty fields have leaves like any other. A null order value comes first. Rows with the
same order value ascend by leaf; equal rows have equal leaves and one place each. Texts of any
length are hashed whole. An empty table gives an empty manifest. Only the columns named are read, so
others may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.positions import numbered
from patronlens.workspace import stage

LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCK = ["tree", "block"]
_NODE = "tree long, pos long, n long, digest string"
_PATH = "tree long, pos long, siblings array<string>, sides string, subroot string, root string"


def field(value: Column) -> Column:
    """A field as it enters a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def parents(nodes: Sequence[str]) -> list[str]:
    """The next level: two nodes become one; a last one without a partner becomes its digest."""
    return [digest("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]


def reduced(nodes: Sequence[str], height: int) -> list[list[str]]:
    """All levels of a superblock, from its nodes up to the one that stands for it."""
    levels = [list(nodes)]
    for _ in range(height):
        levels.append(parents(levels[-1]))
    return levels


def height_of(n: int, levels: int) -> int:
    """Levels to climb inside a superblock of a tree that has ``n`` nodes."""
    return min(levels, (n - 1).bit_length())


def inner_path(levels: Sequence[Sequence[str]], place: int) -> tuple[list[str], str]:
    """Siblings of one node inside its superblock, and on which side each level has one."""
    siblings, sides = [], []
    for nodes in levels[:-1]:
        other = place ^ 1
        if other < len(nodes):
            siblings.append(nodes[other])
            sides.append("L" if place & 1 else "R")
        else:
            sides.append("-")
        place >>= 1
    return siblings, "".join(sides)


def fold(leaf: str, siblings: Sequence[str], sides: str) -> str:
    """The root that a leaf and its proof give."""
    node, rest = leaf, iter(siblings)
    for side in sides:
        node = digest({"L": lambda n: next(rest) + n, "R": lambda n: n + next(rest), "-": lambda n: n}[side](node))
    return node


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", levels))


def _climb(nodes: DataFrame, levels: int) -> DataFrame:
    """The nodes of the next round: one per superblock."""

    def reduce_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        n = int(block["n"].iloc[0])
        top = reduced(block["digest"].tolist(), height_of(n, levels))[-1]
        (node,) = top
        place = int(block["pos"].iloc[0]) >> levels
        return pd.DataFrame({"tree": block["tree"].iloc[:1], "pos": [place], "n": [-(-n >> levels)], "digest": [node]})

    blocks = _in_blocks(nodes.select("tree", "pos", "n", "digest"), levels)
    return blocks.groupBy(*_BLOCK).applyInPandas(reduce_block, _NODE)


def _rounds(nodes: DataFrame, levels: int, label: str) -> list[DataFrame]:
    """``nodes`` and what they reduce to, round by round, until every tree has one node."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n").alias("n")).first().n or 0) > 1:
        rounds.append(stage(_climb(rounds[-1], levels), f"{label}-nodes"))
    return rounds


def _descend(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Whole paths of ``nodes``, from the paths of the superblocks that hold them."""

    def join_paths(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, top = block.sort_values("pos"), above.iloc[0]
        tree = reduced(block["digest"].tolist(), height_of(int(block["n"].iloc[0]), levels))
        paths = [inner_path(tree, i) for i in range(len(block))]
        return pd.DataFrame(
            {
                "tree": block["tree"],
                "pos": block["pos"],
                "siblings": [[*inner, *top.siblings] for inner, _ in paths],
                "sides": [sides + top.sides for _, sides in paths],
                "subroot": top.subroot,
                "root": top.root,
            }
        )

    blocks = _in_blocks(nodes.select("tree", "pos", "n", "digest"), levels).groupBy(*_BLOCK)
    return blocks.cogroup(_outer(outer)).applyInPandas(join_paths, _PATH)


def _outer(paths: DataFrame):
    return paths.withColumnRenamed("pos", "block").groupBy(*_BLOCK)


def _proofs(leaves: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The last exchange: local reduction, proofs and folding of each superblock of leaves."""

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, top = block.sort_values("pos"), above.iloc[0]
        leaves_ = block["digest"].tolist()
        tree = reduced(leaves_, height_of(int(block["n"].iloc[0]), levels))
        changed = block["changed"].tolist()
        siblings, sides, folded = [], [], []
        for i, leaf in enumerate(leaves_):
            inner, inner_sides = inner_path(tree, i)
            siblings.append([*inner, *top.siblings])
            sides.append(inner_sides + top.sides)
            folded.append(fold(changed[i] or leaf, siblings[-1], sides[-1]))
        return pd.DataFrame(
            {
                "place": block["place"],
                "leaf": leaves_,
                "subroot": top.subroot,
                "root": top.root,
                "siblings": siblings,
                "sides": sides,
                "folded_root": folded,
            }
        )

    schema = (
        "place string, leaf string, subroot string, root string, siblings array<string>, sides string, "
        "folded_root string"
    )
    blocks = _in_blocks(leaves, levels).groupBy(*_BLOCK)
    return blocks.cogroup(_outer(outer)).applyInPandas(finish, schema)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    changed: Mapping[str, Column] | None = None,
    changed_where: Column | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: ``order, leaf, subroot, root, siblings, sides, folded_root,
    verified``.

    ``siblings`` is the proof, level by level from the leaf to the root; ``sides`` has a letter
    per level: L or R where the sibling stands, ``-`` where the node is alone. ``folded_root`` follows
    the proof from the leaf or, for rows where ``changed_where`` holds, from the leaf of the row with the columns
    ``changed`` in place of its own. ``verified`` tells whether that is the root. The order column
    must be one that survives a cast to string and back.
    """
    original = [F.col(f) for f in fields]
    other = [(changed or {}).get(f, F.col(f)) for f in fields]
    changed_leaf = F.lit(None).cast("string")
    if changed:
        where = F.lit(True) if changed_where is None else changed_where
        changed_leaf = F.when(where, leaf_digest(other))
    value = F.col(group).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), value), F.lit("-")).alias("key"),
        F.col(order).alias("place"),
        leaf_digest(original).alias("digest"),
        changed_leaf.alias("changed"),
    )
    placed = numbered(stage(leaves, "manifest-leaves"), ["key"], ["place", "digest"], "manifest-order", total="n")
    # A group's tree is numbered by its first leaf's place among the first leaves of all groups.
    groups = stage(placed.where("pos = 0").select("key", F.lit(0).alias("all")), "manifest-groups")
    trees = stage(numbered(groups, ["all"], ["key"], "manifest-trees", position="tree", total="trees"), "manifest-keys")
    known = placed.join(trees.select("key", "tree"), "key")
    leaves = stage(known.select("tree", "pos", "n", F.col("place").cast("string").alias("place"), "digest", "changed"), "manifest-placed")

    rounds = _rounds(leaves, levels, "manifest")
    count = F.col("trees").alias("n")
    tops = rounds[-1].join(trees.select("tree", "trees"), "tree")
    tops = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), count, "digest")
    upper = _rounds(stage(tops, "manifest-subroots"), levels, "manifest-upper")
    none = F.array().cast("array<string>").alias("siblings")
    paths = upper[-1].select(
        "tree", "pos", none, F.lit("").alias("sides"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    for nodes in reversed(upper[:-1]):
        paths = stage(_descend(nodes, paths, levels), "manifest-paths")
    subroots = upper[0].select("pos", F.col("digest").alias("subroot"))
    paths = stage(
        paths.drop("subroot").join(subroots, "pos").select(
            F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "siblings", "sides", "subroot", "root"
        ),
        "manifest-paths",
    )
    for nodes in reversed(rounds[1:-1]):
        paths = stage(_descend(nodes, paths, levels), "manifest-paths")
    found = _proofs(leaves, paths, levels)
    return found.select(
        F.col("place").cast(docs.schema[order].dataType).alias(order),
        "leaf",
        "subroot",
        "root",
        "siblings",
        "sides",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
