"""A Merkle manifest of a dataset: one hash tree per group of rows and one over the groups, kept as Parquet.

A tree is cut into aligned subtrees ("blocks") of `HEIGHT` levels over 2^`HEIGHT` consecutive nodes. A block is one row of the
manifest, with all its digests in a van Emde Boas layout: the subtree is split at half its height, the top half is laid
out first and the bottom halves after it from left to right, each in the same way again. So a walk from leaf to root
stays within few cache lines at any line size, and `address` finds a node from its depth and index alone, when a block is built
and when siblings are read. The roots of the blocks are the nodes of the next tier, and so on until one is left;
trees of any size are a handful of such rounds. A leaf's block is found by its exact rank, so a group that holds most of all rows is
dealt to as many tasks as it has blocks, and no task holds more than one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import stage
from cutgrid.operators.numbering import ranked

#: Levels of a block above its lowest nodes: 4,096 nodes below, 8,191 digests of 32 bytes in all.
HEIGHT = 12
#: The columns that a row's leaf covers, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_WIDTH = 32


def _sha(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes `index` (from the left) of `depth` (0: the root) lie in a subtree of `levels` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    inner, below = depth - top, levels - top
    return (1 << top) - 1 + (index >> inner) * ((1 << below) - 1) + address(below, inner, index & ((1 << inner) - 1))


def block_height(nodes: int, nodes_of_tree: int, height: int = HEIGHT) -> int:
    """All blocks of a tree with several have the full height, as their last nodes rise alone; a single one ends at its root."""
    return height if nodes_of_tree > 1 << height else max(0, nodes - 1).bit_length()


def laid_out(leaves: list[bytes], height: int) -> bytes:
    """The digests of a block in their layout; nodes that do not exist are zero."""
    levels = height + 1
    out = np.zeros(((1 << levels) - 1, _WIDTH), np.uint8)
    nodes = leaves
    for depth in range(height, -1, -1):
        out[address(levels, depth, np.arange(len(nodes)))] = np.frombuffer(b"".join(nodes), np.uint8).reshape(-1, _WIDTH)
        names = [node.hex() for node in nodes]
        nodes = [bytes.fromhex(_sha(*names[at:at + 2])) for at in range(0, len(names), 2)]
    return out.tobytes()


def siblings(block: bytes, nodes: int, height: int, wanted: np.ndarray) -> list[list[str]]:
    """For each of the lowest nodes `wanted` its steps to the block's root: `L` or `R` and the sibling's digest, `-` for none."""
    levels, steps = height + 1, []
    for up in range(height):
        own = wanted >> up
        other = own ^ 1
        count = -(-nodes >> up)
        there = other < count
        at = address(levels, height - up, np.where(there, other, own))
        steps.append([
            ("L" if o < w else "R") + block[a * _WIDTH:(a + 1) * _WIDTH].hex() if t else "-"
            for o, w, a, t in zip(other.tolist(), own.tolist(), at.tolist(), there.tolist())
        ])
    return [list(path) for path in zip(*steps)] if steps else [[] for _ in range(len(wanted))]


def leaf(column) -> Column:
    """Hex sha256 of the columns: `-` for null, else length in bytes, `:` and value. `column(name)` gives the value."""
    def part(name: str) -> Column:
        value = column(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, COLUMNS)), 256)


def _key(group: Column) -> Column:
    """A name for a group that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _block_rows(nodes: DataFrame, tier: int, height: int) -> DataFrame:
    """tree, tier, block, n (nodes of the tier's whole tree), size, height, nodes, root: `nodes` has tree, rank, n, digest."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        size, n = group.num_rows, group.column("n")[0].as_py()
        tall = block_height(size, n, height)
        block = laid_out(group.column("digest").to_pylist(), tall)
        return pa.table({
            "tree": group.column("tree").slice(0, 1), "tier": pa.array([tier], pa.int32()), "block": group.column("block").slice(0, 1),
            "n": pa.array([n]), "size": pa.array([size]), "height": pa.array([tall], pa.int32()),
            "nodes": pa.array([block], pa.binary()), "root": pa.array([block[:_WIDTH]], pa.binary()),
        })

    return (
        nodes.select("tree", "rank", "n", "digest", F.shiftright("rank", height).alias("block"))
        .groupBy("tree", "block")
        .applyInArrow(build, "tree string, tier int, block long, n long, size long, height int, nodes binary, root binary")
    )


def _tiers(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The staged blocks of each tier, lowest first, and the root of every tree: tree, root."""
    tiers, roots = [], []
    while True:
        blocks = stage(_block_rows(nodes, len(tiers), height))
        tiers.append(blocks)
        alone = F.col("n") <= 1 << height
        roots.append(blocks.filter(alone).select("tree", "root"))
        many = blocks.filter(~alone)
        if many.isEmpty():
            break
        nodes = many.select(
            "tree", F.col("block").alias("rank"), F.shiftright(F.col("n") + ((1 << height) - 1), height).alias("n"),
            F.col("root").alias("digest"),
        )
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return tiers, found


def _from_above(blocks: DataFrame) -> DataFrame:
    """tree, block, above: the way to the tree's top for each lowest node of `blocks`, which have `above` themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for first in range(0, row["size"], 256):
                    wanted = np.arange(first, min(first + 256, row["size"]))
                    paths = siblings(row["nodes"], row["size"], row["height"], wanted)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["tree"]] * len(wanted), pa.string()), pa.array((row["block"] << row["shift"]) + wanted),
                        pa.array([path + row["above"] for path in paths], pa.list_(pa.string())),
                    ], names=["tree", "block", "above"])

    return blocks.select("tree", "block", "size", "height", "shift", "nodes", "above").mapInArrow(
        run, "tree string, block long, above array<string>")


def _with_above(tiers: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """The lowest blocks with `above`; `top` has tree and above, the way from each tree's root on."""
    reached = None
    for tier in reversed(tiers):
        last = tier.filter(F.col("n") <= 1 << height).join(top, "tree")
        inner = tier.filter(F.col("n") > 1 << height)
        blocks = last if reached is None else last.unionByName(inner.join(reached, ["tree", "block"]))
        if tier is not tiers[0]:
            reached = stage(_from_above(blocks.withColumn("shift", F.lit(height))))
    return blocks


@dataclass
class Manifest:
    """`leaves`: tree, rank, n, doc_id, digest and what else the rows carry. `blocks`: the rows of all tiers of all group trees.
    `groups`: tree, root. `root`: hex."""

    leaves: DataFrame
    tiers: list[DataFrame]
    groups: DataFrame
    group_tiers: list[DataFrame]
    root: str
    height: int

    @property
    def blocks(self) -> DataFrame:
        rows = self.tiers[0]
        for tier in self.tiers[1:]:
            rows = rows.unionByName(tier)
        return rows


def build(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of `rows`, which have `lang`, `doc_id`, `leaf` (hex) and columns that are carried along.

    Leaves ascend by `doc_id` (null first) in the tree of their `lang`; rows that tie stand in the order of their leaves, and
    repeated rows are leaves each. Null is a group of its own and comes first. An empty table has the root
    of no bytes and no blocks.
    """
    named = rows.withColumn("tree", _key(F.col("lang"))).withColumn("digest", F.unhex("leaf")).drop("leaf", "lang")
    leaves = stage(ranked(stage(named), ["tree"], ["doc_id", "digest"]))
    tiers, roots = _tiers(leaves, height)
    groups = stage(roots)
    whole = groups.select(F.lit("all").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    numbered = stage(ranked(whole, ["tree"], ["name"]))
    group_tiers, top = _tiers(numbered, height)
    found = top.collect()  # one row, as there is one tree
    return Manifest(leaves, tiers, numbered, group_tiers, found[0]["root"].hex() if found else _sha(), height)


def prove(manifest: Manifest) -> DataFrame:
    """The carried columns of each leaf with leaf (hex), subroot (hex) and path: the steps from the leaf to the root of all.

    A step is `L` or `R` with the hex digest of the sibling on that side, or `-` where a node rises alone.
    """
    shift = manifest.height
    over = _with_above(manifest.group_tiers, manifest.groups.select("tree", F.array().cast("array<string>").alias("above")).distinct(), shift)
    by_rank = _from_above(over.withColumn("shift", F.lit(shift))).select(F.col("block").alias("rank"), "above")
    top = stage(manifest.groups.join(by_rank, "rank").select(
        F.col("name").alias("tree"), F.lower(F.hex("digest")).alias("subroot"), "above"))
    lowest = _with_above(manifest.tiers, top.select("tree", "above"), shift)
    carried = [c for c in manifest.leaves.columns if c not in ("tree", "rank", "n", "digest")]
    kinds = ", ".join(f"`{c}` {manifest.leaves.schema[c].dataType.simpleString()}" for c in carried)

    def find(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        block = blocks.select(["size", "height", "nodes", "above"]).to_pylist()[0]
        places = leaves.column("rank").to_numpy() & ((1 << shift) - 1)
        paths = siblings(block["nodes"], block["size"], block["height"], places)
        return leaves.select(["tree", *carried]).append_column(
            "leaf", pa.array([digest.hex() for digest in leaves.column("digest").to_pylist()], pa.string())
        ).append_column("path", pa.array([path + block["above"] for path in paths], pa.list_(pa.string())))

    proved = (
        manifest.leaves.withColumn("block", F.shiftright("rank", shift)).groupBy("tree", "block")
        .cogroup(lowest.select("tree", "block", "size", "height", "nodes", "above").groupBy("tree", "block"))
        .applyInArrow(find, f"tree string, {kinds}, leaf string, path array<string>")
    )
    subroots = top.select("tree", "subroot")
    return proved.join(subroots, "tree").drop("tree")


def digests(path: Column) -> Column:
    """The siblings of a path, joined: what the proof hashes."""
    return F.array_join(F.transform(path, lambda step: F.substring(step, 2, 64)), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    def up(node: Column, step: Column) -> Column:
        other = F.substring(step, 2, 64)
        return F.sha2(F.when(step.startswith("L"), F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(path, leaf, up)
