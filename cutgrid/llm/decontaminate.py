"""Benchmark passages in documents, found by multi-pattern search over words.

A window (ten consecutive words of an item, or the whole of a shorter one) is a pattern; words are the symbols. Per
window length there is a table of block shifts: how far a window's end must lie behind a block (two words) at
least. A document is probed once per stride of length minus block plus one; a block that no window holds rules out
every end in its stride. What is left is shifted on until a block can end a window; then the hash of the last
words selects the test strings, and a comparison of all words confirms.

Items go out in blocks of at most `ITEM_BYTES`, so what is broadcast and held by a task is bounded whatever the
size of the benchmark; with several blocks each one is searched in all documents and the hits are put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cutgrid.functions.sizing import stage
from cutgrid.llm.common import map_texts, with_digest, without

WINDOW = 10
BLOCK = 2
SUFFIX = 5
ITEM_BYTES = 8 << 20
#: Window comparisons held at once in a task.
_AT_ONCE = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words as UTF-8: digits, letters a-z and everything beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_SPLIT).split() if text else []


def _mixed(ids: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words that end at `ends`."""
    value = np.zeros(len(ends), np.uint64)
    for back in range(length):
        value = (value ^ ids[ends - back].astype(np.uint64)) * _MIX
        value ^= value >> np.uint64(29)
    return value


class _Patterns:
    """The tables of all windows of one length."""

    def __init__(self, length: int, windows: list[tuple[int, ...]], items: list[list[int]]):
        self.length, self.block, self.suffix = length, min(BLOCK, length), min(SUFFIX, length)
        self.windows, self.items = np.array(windows, np.int64), items
        ends = np.arange(len(windows)) * length + length - 1
        flat = self.windows.ravel()
        codes, shifts = [], []
        for back in range(length - self.block + 1):
            codes.append(_mixed(flat, ends - back, self.block))
            shifts.append(np.full(len(ends), back, np.int64))
        code, shift = np.concatenate(codes), np.concatenate(shifts)
        order = np.lexsort((shift, code))
        self.codes, first = np.unique(code[order], return_index=True)
        self.shifts = shift[order][first]
        suffix = _mixed(flat, ends, self.suffix)
        self.by_suffix = np.argsort(suffix, kind="stable")
        self.suffixes = suffix[self.by_suffix]

    def _shift(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        code = _mixed(ids, ends, self.block)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.shifts[at], self.length - self.block + 1)

    def _ends(self, ids: np.ndarray) -> np.ndarray:
        """Positions at which the shift table lets a window end."""
        stride = self.length - self.block + 1
        at = np.arange(self.length - 1, len(ids) + stride, stride)
        last = np.minimum(at + stride, len(ids))
        at, last = at[at < len(ids)], last[at < len(ids)]
        found = []
        while len(at):
            shift = np.full(len(at), stride)
            probe = (ids[at] > 0) & (ids[at - self.block + 1] > 0)
            shift[probe] = self._shift(ids, at[probe])
            found.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            stay = at < last
            at, last = at[stay], last[stay]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def find(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(end positions, window numbers) of all occurrences, in bounded pieces."""
        ends = self._ends(ids)
        code = _mixed(ids, ends, self.suffix)
        low, high = np.searchsorted(self.suffixes, code, "left"), np.searchsorted(self.suffixes, code, "right")
        ends, low, count = ends[high > low], low[high > low], (high - low)[high > low]
        total = np.concatenate([[0], np.cumsum(count)])
        for begin in range(0, int(total[-1]), _AT_ONCE):
            pair = np.arange(begin, min(begin + _AT_ONCE, int(total[-1])))
            own = np.searchsorted(total, pair, "right") - 1
            number = self.by_suffix[low[own] + pair - total[own]]
            end = ends[own]
            equal = np.ones(len(pair), bool)
            for back in range(self.length):
                equal &= ids[end - back] == self.windows[number, self.length - 1 - back]
            yield end[equal], number[equal]


class _Search:
    """All windows of a block of items, ready to look through the texts of a batch."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items if name is not None})
        number = {name: i for i, name in enumerate(self.names)}
        windows: dict[tuple[int, ...], set[int]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary) + 1) for word in words(text)]
            for start in range(max(1, len(ids) - WINDOW + 1)) if ids else ():
                windows.setdefault(tuple(ids[start:start + WINDOW]), set()).add(number.get(name, -1))
        self.patterns = [
            _Patterns(length, own, [sorted(windows[w]) for w in own])
            for length in range(1, WINDOW + 1) if (own := [w for w in windows if len(w) == length])
        ]

    def look(self, texts: list[str | None]) -> tuple[list[int], list[np.ndarray], list[set[int]]]:
        """Of each text: its number of words, where words are hit, and the numbers of the items found."""
        sizes, parts = [], []
        known = self.vocabulary.get
        for text in texts:
            own = words(text)
            sizes.append(len(own))
            parts.append(np.fromiter((known(word, 0) for word in own), np.int64, len(own)))
        # A word that no window has stands between texts, so that no window reaches over.
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
        ids = np.zeros(int(starts[-1]), np.int64)
        for start, part in zip(starts, parts):
            ids[start:start + len(part)] = part
        change = np.zeros(len(ids) + 1, np.int64)
        items: list[set[int]] = [set() for _ in texts]
        for patterns in self.patterns:
            for ends, numbers in patterns.find(ids):
                np.add.at(change, ends - patterns.length + 1, 1)
                np.add.at(change, ends + 1, -1)
                for text, number in set(zip((np.searchsorted(starts, ends, "right") - 1).tolist(), numbers.tolist())):
                    items[text].update(patterns.items[number])
        hit = np.cumsum(change[:-1]) > 0
        return sizes, [hit[a:a + n] for a, n in zip(starts, sizes)], items


def _ranges(hit: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_RANGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(_RANGE)),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("digest", T.StringType()),
]


def _begin(shared, digest: bool):
    def begin():
        search = _Search(shared.value)

        def work(texts: list[str | None]) -> list[pa.Array]:
            sizes, hits, items = [], [], []
            for first in range(0, len(texts), 512):
                n, hit, found = search.look(texts[first:first + 512])
                sizes += n
                hits += [_ranges(h) for h in hit]
                items += [[search.names[i] for i in sorted(own) if i >= 0] for own in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            key = [hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).hexdigest() if digest else None for t in texts]
            return [pa.array(sizes, pa.int64()), pa.array(hits, kind), pa.array(items, pa.list_(pa.string())), pa.array(key, pa.string())]

        return work

    return begin


def _blocks(benchmark: DataFrame, item_bytes: int) -> list[DataFrame]:
    """The items, each once, in blocks of at most `item_bytes`; a block is what the driver and a task hold at once.

    Blocks are dealt by a hash and measured; while one is too large there are twice as many. A single item above the limit is a block.
    """
    items = stage(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct())
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    number = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // item_bytes))
    while True:
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
        dealt = items.groupBy(own.alias("block")).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("items"))
        if dealt.filter((F.col("bytes") > item_bytes) & (F.col("items") > 1)).isEmpty():
            break
        number *= 2
    if number == 1:
        return [items]
    named = sorted(row.block for row in dealt.select("block").collect())
    return [items.filter(own == block) for block in named]


def _merged(ranges):
    """Ranges of several blocks as disjoint ranges in order."""
    longer = F.array_sort(F.flatten(ranges))
    return F.aggregate(
        longer, F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda seen, r: F.when(
            (F.size(seen) > 0) & (F.element_at(seen, -1)["end"] >= r["start"]),
            F.concat(F.slice(seen, F.lit(1), F.size(seen) - 1), F.array(F.struct(
                F.element_at(seen, -1)["start"].alias("start"),
                F.greatest(F.element_at(seen, -1)["end"], r["end"]).alias("end")))),
        ).otherwise(F.concat(seen, F.array(r))),
    )


def search(docs: DataFrame, benchmark: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """doc_id, n_words, hits (start, end in words), items (sorted as strings): one row per row of `docs`.

    Null and empty texts have no words and no hits; an item without words has no window; an item without id is
    searched but not listed; items with equal texts are all listed; repeated documents are each searched. An empty
    benchmark gives no hits, empty documents an empty result. Repeated items count once. Only the named columns are read.
    """
    spark, blocks = docs.sparkSession, _blocks(benchmark, item_bytes)

    def looked(block: DataFrame):
        return spark.sparkContext.broadcast([(row.item_id, row.text) for row in block.collect()])

    if len(blocks) == 1:
        return map_texts(docs, _begin(looked(blocks[0]), False), _FIELDS).drop("digest")
    every = None
    for number, block in enumerate(blocks):
        shared = looked(block)
        one = stage(map_texts(docs, _begin(shared, True), _FIELDS).withColumn("block", F.lit(number)))
        shared.destroy()
        every = one if every is None else every.unionByName(one)
    together = every.groupBy("doc_id", "digest").agg(
        F.first("n_words").alias("n_words"), _merged(F.collect_set("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.sum(F.when(F.col("block") == 0, 1).otherwise(0)).cast("long").alias("rows"),
    )
    return together.select(
        "doc_id", "n_words", "hits", "items", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("row")
    ).drop("row")


def n_hit(hits) -> Column:
    return F.aggregate(hits, F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of `docs` without any hit word, with all their columns; rows that share an id, or have none, are told apart by text."""
    return without(docs, search(with_digest(docs), benchmark, item_bytes).filter(F.size("hits") > 0))
