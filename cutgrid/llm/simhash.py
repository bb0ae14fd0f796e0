"""SimHash near duplicates: fingerprints of whole texts, linked through vantage-point trees.

Two fingerprints at most `DISTANCE` bits apart agree in all bits of at least one of `DISTANCE` + 1 bands, so each distinct fingerprint is
dealt once per band, with all others of the same value there: four copies, however many fingerprints there are. Values are
gathered to shards of about `SHARD` fingerprints by a hash. A value with more than `LARGEST` fingerprints is dealt again by
bands of its other bits, by the same argument, and so on while bits are left. A shard parts its fingerprints by vantage
points: what lies within a radius goes inside and the rest outside. Two linked fingerprints differ by no more than `DISTANCE` in their
distance to a vantage point, so a branch is searched only by those whose distance allows it: a fingerprint near the boundary visits the
other side too. Leaves are compared in full. Each shard joins what it has linked and returns one link per fingerprint, so a
group of near copies does not return all its pairs; components of these links are found by joins over all shards.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cutgrid.functions.sizing import small, stage
from cutgrid.llm.common import kept_once, map_texts
from cutgrid.llm.components import components

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints of a shard, about, and of one value of a band at most before it is dealt again.
SHARD, LARGEST = 1 << 12, 1 << 14
_LEAF = 512
_AT_ONCE = 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, as a signed number: a bit is set if it is set in over half of the shingles' hashes."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], seed) for a, b in zip([0, *ends], ends[shingle - 1:])]
    bits = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[first:first + (1 << 16)], np.uint64).view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, digest: bool = False) -> DataFrame:
    """doc_id, fp (long) and, if wanted, the text's sha256: one row per row of `docs`; null, empty and blank texts have 0."""

    def begin():
        def work(texts: list[str | None]) -> list[pa.Array]:
            columns = [pa.array([fingerprint(text, shingle, seed) for text in texts], pa.int64())]
            if digest:
                columns.append(pa.array([hashlib.sha256((text or "").encode()).hexdigest() for text in texts], pa.string()))
            return columns

        return work

    return map_texts(docs, begin, [
        T.StructField("fp", T.LongType()), *([T.StructField("digest", T.StringType())] if digest else []),
    ])


def as_hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _apart(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int64)


def _vantage(points: np.ndarray, distance: int, tried: int = 8) -> tuple[np.uint64, int] | None:
    """A point and radius that put about half of `points` inside and leave few near the boundary; None if none parts them."""
    some = points[:: max(1, len(points) // 2048)]
    best = None
    for vantage in some[:: max(1, len(some) // tried)][:tried]:
        apart = _apart(some, vantage)
        radius = int(np.median(apart))
        if radius >= apart.max():
            radius = int(apart.max()) - 1
        if radius < apart.min():
            continue
        near = float(((apart > radius - distance) & (apart <= radius + distance)).mean()) + abs(float((apart <= radius).mean()) - 0.5)
        if best is None or near < best[0]:
            best = (near, vantage, radius)
    return None if best is None else (best[1], best[2])


def _sides(homes, visitors, vantage, radius, distance):
    """Inside and outside as (homes, visitors) index arrays are dealt: homes once, visitors where the bound allows."""
    (home_points, home_rows), (visit_points, visit_rows) = homes, visitors
    apart, visit = _apart(home_points, vantage), _apart(visit_points, vantage)
    inside, crossing = apart <= radius, (apart <= radius) & (apart > radius - distance)
    low, high = visit <= radius + distance, visit > radius - distance
    within = (home_points[inside], home_rows[inside]), (visit_points[low], visit_rows[low])
    beyond = (home_points[~inside], home_rows[~inside]), (
        np.concatenate([visit_points[high], home_points[crossing]]), np.concatenate([visit_rows[high], home_rows[crossing]]))
    return within, beyond


class _Joined:
    """Which rows belong together; the smallest row stands for all."""

    def __init__(self, count: int):
        self.parent = np.arange(count)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        root = self.parent[rows]
        while True:
            above = self.parent[root]
            if (above == root).all():
                return root
            root = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            a, b = a[differ], b[differ]
            if not len(a):
                return
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def linked(own: np.ndarray, visiting: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For each of `own` and then `visiting` the row that stands for its component; visitors are not compared with each other."""
    joined = _Joined(len(own) + len(visiting))
    todo = [((own, np.arange(len(own))), (visiting, np.arange(len(visiting)) + len(own)))]
    while todo:
        homes, visitors = todo.pop()
        points, rows = homes
        if not len(points):
            continue
        chosen = _vantage(points, distance) if len(points) > _LEAF else None
        if chosen is not None:
            todo += _sides(homes, visitors, *chosen, distance)
            continue
        every, every_rows = np.concatenate([points, visitors[0]]), np.concatenate([rows, visitors[1]])
        for first in range(0, len(points), _LEAF):
            block, block_rows = points[first:first + _LEAF], rows[first:first + _LEAF]
            step = _AT_ONCE // len(block)
            for begin in range(first, len(every), step):
                near = np.bitwise_count(every[begin:begin + step, None] ^ block[None, :]) <= distance
                i, j = np.nonzero(near)
                joined.join(every_rows[begin + i], block_rows[j])
    return joined.roots(np.arange(len(joined.parent)))


def bands(fixed: int, distance: int = DISTANCE) -> list[int]:
    """The bits that are not in `fixed`, cut into `distance` + 1 runs, each as `fixed` and the run; none if too few bits are left."""
    bits = [bit for bit in range(64) if not fixed >> bit & 1]
    cuts = [len(bits) * part // (distance + 1) for part in range(distance + 2)]
    if len(bits) <= distance:
        return []
    return [fixed | sum(1 << bit for bit in bits[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


#: How often a fingerprint is dealt at most: what is still together then differs in 20 bits only, so it is at most 2^20 fingerprints.
ROUNDS = 4


def dealt(prints: DataFrame, distance: int = DISTANCE, shard: int = SHARD, largest: int = LARGEST) -> DataFrame:
    """fp, mask, shard: every pair of fingerprints at most `distance` bits apart meets in some (mask, shard)."""
    masks, left, parts = [0], prints.select("fp", F.lit(0).cast("long").alias("mask")), None
    for turn in range(ROUNDS):
        finer = {mask: bands(mask, distance) for mask in masks}
        listed = F.create_map(*[x for mask, more in finer.items() for x in (
            F.lit(_signed(mask)).cast("long"), F.array(*[F.lit(_signed(m)).cast("long") for m in more]))])
        rows = left.select("fp", F.explode(F.element_at(listed, F.col("mask"))).alias("mask"))
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        counts = stage(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")))
        total = counts.agg(F.sum("n")).first()[0] or 0
        masks = [m for more in finer.values() for m in more]
        shards = max(1, -(-total // len(masks) // shard))
        large = counts.filter(F.col("n") > largest).select("mask", "value")
        last = turn == ROUNDS - 1 or not bands(masks[0], distance) or large.isEmpty()
        here = rows if last else rows.join(small(large), ["mask", "value"], "left_anti")
        here = here.select("fp", "mask", F.pmod(F.xxhash64("value"), F.lit(shards)).alias("shard"))
        parts = here if parts is None else parts.unionByName(here)
        if last:
            return parts
        left = stage(rows.join(small(large), ["mask", "value"], "left_semi").select("fp", "mask"))


def links(prints: DataFrame, distance: int = DISTANCE, shard: int = SHARD, largest: int = LARGEST) -> DataFrame:
    """a, b: fingerprints that belong together; every linked one is connected with all others of its component."""

    def join(group: pa.Table) -> pa.Table:
        values = group.column("fp").to_numpy().view(np.uint64)
        root = linked(values, values[:0], distance)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": values[moved].view(np.int64), "b": values[root[moved]].view(np.int64)})

    return dealt(prints, distance, shard, largest).groupBy("mask", "shard").applyInArrow(join, "a long, b long")


def _grouped(rows: DataFrame, distance: int, shard: int, largest: int) -> DataFrame:
    """`rows` with root (one fingerprint of the component) and component_id."""
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(prints, distance, shard, largest)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def groups(
    docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE, shard: int = SHARD, largest: int = LARGEST
) -> DataFrame:
    """doc_id, fp, component_id (smallest id of the component): one row per row of `docs`.

    Null, empty and blank texts have fingerprint 0 and are linked like any other; equal texts and repeated rows share a
    fingerprint; null ids count only where a component has no other. An empty table gives an empty result. Only `doc_id`
    and `text` are read.
    """
    grouped = _grouped(stage(fingerprints(docs, shingle, seed)), distance, shard, largest)
    return grouped.select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE) -> DataFrame:
    """Of each component one row with its smallest id, with all its columns (of several such rows, the first by digest)."""
    prints = stage(fingerprints(docs, shingle, seed, digest=True))
    least = _grouped(prints, distance, SHARD, LARGEST).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Rows that are alike in id and digest are counted here, where there are no texts to move.
    keep = stage(
        least.groupBy("root", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("root").agg(F.min(F.struct("doc_id", "digest", "rows")).alias("kept"))
        .select(F.col("kept.doc_id").alias("__keep_id"), F.col("kept.digest").alias("__keep_digest"), F.col("kept.rows").alias("__rows"))
    )
    return kept_once(docs, keep, F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
