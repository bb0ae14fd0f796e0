"""Documents cut and mixed into sequences of a fixed number of tokens, by deficit round-robin over the queues of their sources.

Each source is a queue of tokens, its documents one after another, each with an end id. In every round a queue is
credited its share of a window; it is served whole packets of `PACKET` tokens as far as its credit goes, and what is left (its deficit)
is carried to the next round, over windows and partitions alike. The served tokens of a round follow each
other queue by queue, rounds follow rounds, and every `WINDOW` tokens of this stream are a sequence. A queue is never more than a packet
behind its credit at the end of a round, so windows keep the shares closely, and none has padding. When a queue is empty, the credit is shared out anew among
the others (a new phase), whose deficits go on.

Credits are linear in the rounds, so what a queue has been served before any round is a formula, and so is the place in the stream of
any token whose place in its queue is known. No task needs the rounds before its own: documents are placed where they lie, and only sums
of tokens by source and task are gathered. The tokens left after the last whole window make sequences whose lengths are powers of two,
largest first, so nothing is padded at all.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cutgrid.functions.sizing import small, stage
from cutgrid.llm.common import pieces as slices

#: Tokens of a sequence.
WINDOW = 2048
#: Tokens that a queue is served at once.
PACKET = 32
#: Id that ends a document.
END = 1
#: Sources with a queue of their own, the largest ones; all further ones share `SHARED` queues by a hash.
OWN, SHARED = 1024, 64
#: Credits are counted in parts of a token.
PART = 1 << 16
_CELLS = 1 << 17


class Encoder:
    """The ids of `vocabulary`, a file of the tokenizers library, without special tokens: written out in a text they are text.

    With `ranks`, the same vocabulary as a file of the tiktoken library, that one encodes, several times faster and with the same
    ids (the tests compare them); a text that it refuses still goes to the first.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        self.vocabulary, self.quick = vocabulary, None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as file:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    @cached_property
    def plain(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.vocabulary)
        library.encode_special_tokens = True
        return library

    def __call__(self, text: str) -> list[int]:
        if self.quick is not None:
            try:
                return self.quick.encode_ordinary(text)
            except BaseException as error:  # a Rust panic is no Exception
                if type(error).__name__ not in ("PanicException", "ValueError"):
                    raise
        return self.plain.encode(text, add_special_tokens=False).ids


def _source(name) -> str:
    return "-" if name is None else f"={name}"


def encoded(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None, end: int = END) -> DataFrame:
    """doc_id, source (never null), part, before, n, width, ids: `before` counts the tokens of the source earlier in the same task.

    `ids` are little-endian numbers of `width` bytes (two where they fit) and end with `end`; null and empty texts have only that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = Encoder(vocabulary, ranks, pattern), TaskContext.get().partitionId()
        so_far: dict[str, int] = {}
        for batch in slices(batches):
            names = [_source(name) for name in batch.column(1).to_pylist()]
            before, sizes, widths, packed = [], [], [], []
            for name, text in zip(names, batch.column(2).to_pylist()):
                ids = encode(text) if text else []
                before.append(so_far.get(name, 0))
                sizes.append(len(ids) + 1)
                so_far[name] = before[-1] + sizes[-1]
                ids = np.array([*ids, end], np.uint32)
                widths.append(2 if ids.max() < 1 << 16 else 4)
                packed.append(ids.astype(f"<u{widths[-1]}").tobytes())
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(names, pa.string()), pa.array([part] * count, pa.int64()), pa.array(before, pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(widths, pa.int32()), pa.array(packed, pa.binary()),
            ], names=["doc_id", "source", "part", "before", "n", "width", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "source", "text").mapInArrow(
        run, f"doc_id {kind}, source string, part long, before long, n long, width int, ids binary")


@dataclass
class Phase:
    """A stretch of rounds in which the same queues are served. Arrays have an entry per queue."""

    at: int  # tokens of the stream before it
    served: np.ndarray  # tokens of each queue before it
    deficit: np.ndarray  # credit carried in, in parts of a token
    quantum: np.ndarray  # credit a round, in parts of a token
    left: np.ndarray  # tokens of each queue from here on
    rounds: int

    def after(self, rounds: np.ndarray, packet: int) -> np.ndarray:
        """Tokens served of each queue (columns) in the first `rounds` rounds (rows) of this phase."""
        credit = (self.deficit + rounds[:, None] * self.quantum) // PART
        return np.where(credit >= self.left, self.left, credit // packet * packet)


def schedule(tokens: Sequence[int], shares: Sequence[float], window: int = WINDOW, packet: int = PACKET) -> list[Phase]:
    """The phases until all queues, of `tokens` each, are empty; among those left, `shares` keep their proportions."""
    total, weight = np.array(tokens, np.int64), np.array(shares, np.float64)
    served, deficit, at, phases = np.zeros_like(total), np.zeros_like(total), 0, []
    while (served < total).any():
        open_ = served < total
        wanted = np.where(open_, weight, 0.0)
        if not wanted.any():  # queues without a share are emptied when all others are
            wanted = open_.astype(np.float64)
        quantum = np.where(wanted > 0, np.maximum(1, np.round(PART * window * wanted / wanted.sum())), 0).astype(np.int64)
        left = np.where(open_, total - served, 0)
        deficit = np.where(open_, deficit, 0)
        served_now = quantum > 0
        needed = -(-(left[served_now] * PART - deficit[served_now]) // quantum[served_now])
        phase = Phase(at, served, deficit, quantum, left, max(1, int(needed.min())))
        phases.append(phase)
        now = phase.after(np.array([phase.rounds]), packet)[0]
        deficit = deficit + phase.rounds * quantum - now * PART
        served, at = served + now, at + int(now.sum())
    return phases


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of all ranges first..last (inclusive), one after another."""
    count = last - first + 1
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def placed(phases: list[Phase], queue: np.ndarray, begin: np.ndarray, end: np.ndarray, packet: int = PACKET):
    """Where the tokens begin..end of their queues go: row, offset in the row, length, place in the stream; by row and offset."""
    found = []
    for phase, after in zip(phases, [*(phase.served for phase in phases[1:]), phases[-1].served + phases[-1].left] if phases else []):
        low, high = np.maximum(begin, phase.served[queue]), np.minimum(end, after[queue])
        rows = np.flatnonzero(low < high)
        if not len(rows):
            continue
        own, base = queue[rows], phase.served[queue[rows]]
        inner, number = _runs((low[rows] - base) // packet, (high[rows] - base - 1) // packet)
        own, base = own[inner], base[inner]
        stop = np.minimum((number + 1) * packet, phase.left[own])
        turn = np.maximum(0, -(-(stop * PART - phase.deficit[own]) // phase.quantum[own]) - 1)
        turns, which = np.unique(turn, return_inverse=True)
        start = np.empty(len(turn), np.int64)
        step = max(1, _CELLS // len(phase.quantum))
        for first in range(0, len(turns), step):
            here = (which >= first) & (which < first + step)
            some = turns[first:first + step]
            before, now = phase.after(some, packet), phase.after(some + 1, packet)
            ahead = before.sum(axis=1)[:, None] + np.cumsum(now - before, axis=1) - (now - before) - before
            start[here] = phase.at + ahead[which[here] - first, own[here]] + number[here] * packet
        a, b = np.maximum(low[rows][inner], base + number * packet), np.minimum(high[rows][inner], base + stop)
        found.append((rows[inner], a - begin[rows][inner], b - a, start + a - base - number * packet))
    row, offset, length, place = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 4))
    order = np.lexsort((offset, row))
    row, offset, length, place = row[order], offset[order], length[order], place[order]
    if len(row):
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + length[:-1])
        heads = np.flatnonzero(fresh)
        row, offset, length, place = row[heads], offset[heads], np.add.reduceat(length, heads), place[heads]
    return row, offset, length, place


def tail_starts(total: int, window: int = WINDOW) -> list[int]:
    """Where the sequences after the last whole window begin: powers of two, largest first."""
    at, starts = total // window * window, []
    while at < total:
        starts.append(at)
        at += 1 << (total - at).bit_length() - 1
    return starts


def cut(row, offset, length, place, total: int, window: int = WINDOW):
    """The same stretches cut where sequences end: row, offset in the row, length, sequence, offset in the sequence."""
    whole, tail = total // window, np.array([*tail_starts(total, window), total], np.int64)

    def number(at):
        return np.where(at < whole * window, at // window, whole + np.searchsorted(tail, at, "right") - 1)

    def start(sequence):
        return np.where(sequence < whole, sequence * window, tail[np.clip(sequence - whole, 0, len(tail) - 1)])

    inner, sequence = _runs(number(place), number(place + length - 1))
    place, length, row, offset = place[inner], length[inner], row[inner], offset[inner]
    first, beyond = np.maximum(place, start(sequence)), np.minimum(place + length, start(sequence + 1))
    return row, offset + first - place, beyond - first, sequence, first - start(sequence)


def _queues(parts: DataFrame, own: int, shared: int) -> tuple[DataFrame, list[int], list[str]]:
    """parts with `queue` and `base` (the tokens of the queue before the part's), the tokens of the queues, and the names of the
    first of them. `parts` has source, part and n."""
    largest = parts.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "source").limit(own)
    names = sorted(row.source for row in largest.collect())
    spark = parts.sparkSession
    if names:
        listed = spark.createDataFrame([(name, at) for at, name in enumerate(names)], "source string, own int")
    else:
        listed = spark.createDataFrame([], "source string, own int")
    queue = F.coalesce("own", F.lit(len(names)) + F.pmod(F.xxhash64("source"), F.lit(shared)).cast("int"))
    numbered = parts.join(small(listed), "source", "left").withColumn("queue", queue).drop("own")
    earlier = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    based = stage(numbered.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))).drop("n"))
    sums = {row.queue: row.n for row in numbered.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    return based, [sums.get(at, 0) for at in range(len(names) + shared)], names


def pack(
    docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None, shares: Mapping[str | None, float] | None = None,
    window: int = WINDOW, packet: int = PACKET, end: int = END, own: int = OWN, shared: int = SHARED,
) -> DataFrame:
    """doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset: one row per piece of a document.

    `shares` are the wanted parts of the sources; those not named, and all without it, are wanted as they occur. Sources with
    a share of zero come when all others are packed. Documents of a source
    follow each other as they lie in the files. Every id of every document lies in exactly one piece, and every document has a piece, as
    its end id counts: null and empty texts are that id alone. A null source is a source. Repeated rows and ids are
    packed like any other row. An empty table gives an empty result. Only `doc_id`, `source` and `text` are read.
    """
    staged = stage(encoded(docs, vocabulary, ranks, pattern, end))
    parts = stage(staged.groupBy("source", "part").agg(F.sum("n").alias("n")))
    based, tokens, names = _queues(parts, own, shared)
    total = sum(tokens)
    wanted = {_source(name): share for name, share in (shares or {}).items()}
    free = 1 - sum(wanted.get(name, 0.0) for name in names)
    rest = sum(n for at, n in enumerate(tokens) if at >= len(names) or names[at] not in wanted)
    if rest and free <= 0:
        raise ValueError("the shares leave nothing for the sources they do not name")
    portions = [
        wanted[names[at]] if at < len(names) and names[at] in wanted else free * n / max(1, rest) for at, n in enumerate(tokens)
    ]
    phases = schedule(tokens, portions, window, packet)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            widths = batch.column(4).to_pylist()
            begin, sizes = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            row, start, length, sequence, offset = cut(
                *placed(phases, batch.column(1).to_numpy(), begin, begin + sizes, packet), total, window)
            packed = [np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes() for ids, width in zip(batch.column(5).to_pylist(), widths)]
            ids = [packed[r][4 * a:4 * (a + n)] for r, a, n in zip(row.tolist(), start.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(ids, pa.binary()),
                pa.array(sizes[row]), pa.array(sequence), pa.array(offset),
            ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return (
        staged.join(small(based), ["source", "part"])
        .select("doc_id", F.col("queue").cast("long"), F.col("base") + F.col("before"), "n", "width", "ids")
        .mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids: the sequences themselves, each of one window at most."""

    def fill(group: pa.Table) -> pa.Table:
        ids = b"".join(group.sort_by("offset").column("ids").to_pylist())
        return pa.table({
            "sequence_id": group.column("sequence_id").slice(0, 1), "n_tokens": pa.array([len(ids) // 4], pa.int64()),
            "ids": pa.array([np.frombuffer(ids, "<u4").astype(np.int32)], pa.list_(pa.int32())),
        })

    return pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        fill, "sequence_id long, n_tokens long, ids array<int>")
