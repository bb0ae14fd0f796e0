"""Repair of conversations by the cheapest edits, decided by integer minima over a graph.

A conversation is legal if the initials of its roles read `(s?(ua)+)?`. Each row is kept, given another role or deleted, and rows
without text may be inserted. The weight of an edit is one integer: its cost in the high digits, and below them, in as many places
as the longest list of edits could need, the letter of the edit at the place where it stands in the list. Letters are numbered in
ASCII order and the places behind the last letter are zero, so the smaller of two sums is the cheaper list of edits and, of equally cheap
ones, the first in ASCII order. The nodes of the graph are (rows done, rows inserted, state of the pattern); all lists that lead
to a node have the same number of letters, so the places agree and a plain minimum of sums decides everything.

Rows are put in order by range partitions, so a conversation of any length is dealt over as many tasks as its rows need. A task cuts its part of a
conversation into segments of `SEGMENT` rows, finds the least weight from each state to each state, and joins neighbours in pairs: weights of
two segments are put one behind the other by shifting digits, and minima are taken again. Texts take no part in this. Only
the last step, the digest of a repaired conversation, is sequential by its definition; it reads the rows in order and holds one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cutgrid.functions.sizing import stage

#: Rows whose least weights are found at once.
SEGMENT = 24
#: Costs: another role, deletion, insertion, leaving a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: The edits' letters in ASCII order; places of three bits, zero for none.
LETTERS = "-DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
_BITS = 3
#: States: nothing yet, after s, after u, after a. Which state an initial leads to, and where a conversation may end.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ENDS = (0, 3)
_STATES = 4
_LEGAL = {"su", "ua", "au"}
_BLANK = " \t\n\x0b\x0c\r"

Weights = list[list[int | None]]


def width(rows: int) -> int:
    """Places that the edits of so many rows can need: deletions and two insertions lead everywhere, so more would cost more."""
    return rows + (DELETE * rows + 2 * INSERT) // INSERT


def segment(rows: list[tuple[str, bool, bool]], starts=range(_STATES)) -> Weights:
    """The least weight from each start (others: none) to each state, in `width(len(rows))` places.

    A row is (initial of the role, whether it must go, whether it is truncated).
    """
    places = width(len(rows))
    cost = 1 << _BITS * places
    out: Weights = [[None] * _STATES for _ in range(_STATES)]
    for begin in starts:
        #: layer[inserted][state]
        layer: list[list[int | None]] = [[None] * _STATES for _ in range(places - len(rows) + 1)]
        layer[0][begin] = 0
        for done in range(len(rows) + 1):
            for inserted in range(len(layer) - 1):
                put = INSERT * cost + (_I << _BITS * (places - 1 - done - inserted))
                beyond = layer[inserted + 1]
                for state, weight in enumerate(layer[inserted]):
                    if weight is not None:
                        for initial, to in _NEXT[state].items():
                            if initial != "s" and (beyond[to] is None or weight + put < beyond[to]):
                                beyond[to] = weight + put
            if done == len(rows):
                break
            initial, gone, truncated = rows[done]
            left = TRUNCATED * cost if truncated else 0
            later: list[list[int | None]] = [[None] * _STATES for _ in layer]
            for inserted, nodes in enumerate(layer):
                at = _BITS * (places - 1 - done - inserted)
                into = later[inserted]
                for state, weight in enumerate(nodes):
                    if weight is None:
                        continue
                    steps = [(state, DELETE * cost + (_D << at))]
                    if not gone:
                        for other, to in _NEXT[state].items():
                            if other == initial:
                                steps.append((to, left + (_K << at)))
                            elif other != "s":
                                steps.append((to, left + REROLE * cost + (_R << at)))
                    for to, step in steps:
                        if into[to] is None or weight + step < into[to]:
                            into[to] = weight + step
            layer = later
        for nodes in layer:
            for state, weight in enumerate(nodes):
                if weight is not None and (out[begin][state] is None or weight < out[begin][state]):
                    out[begin][state] = weight
    return out


def _letters(weight: int, places: int) -> int:
    """How many letters a weight has: its places without the zeros at the end."""
    digits = weight & ((1 << _BITS * places) - 1)
    return places - ((digits & -digits).bit_length() - 1) // _BITS if digits else 0


def joined(first: Weights, first_places: int, then: Weights, then_places: int) -> tuple[Weights, int]:
    """The least weights through both, and their places."""
    places = first_places + then_places
    out: Weights = [[None] * _STATES for _ in range(_STATES)]
    low, low_then = (1 << _BITS * first_places) - 1, (1 << _BITS * then_places) - 1
    for begin in range(_STATES):
        for middle in range(_STATES):
            a = first[begin][middle]
            if a is None:
                continue
            empty = first_places - _letters(a, first_places)
            base, high = (a & low) << _BITS * then_places, a >> _BITS * first_places
            for end in range(_STATES):
                b = then[middle][end]
                if b is None:
                    continue
                sum_ = (high + (b >> _BITS * then_places) << _BITS * places) + base + ((b & low_then) << _BITS * empty)
                if out[begin][end] is None or sum_ < out[begin][end]:
                    out[begin][end] = sum_
    return out, places


def audit(weights: Weights, places: int) -> tuple[int, str]:
    """The cost and the letters of the least weight from the empty beginning to a legal end."""
    least = min(weight for weight in (weights[0][end] for end in _ENDS) if weight is not None)
    digits = least & ((1 << _BITS * places) - 1)
    written = f"{digits:0{_BITS * places}b}" if places else ""
    letters = "".join(LETTERS[int(written[at:at + _BITS], 2)] for at in range(0, len(written), _BITS))
    return least >> _BITS * places, letters.rstrip("-")


class Part:
    """What is known of neighbouring rows of one conversation: counts, what stands at both ends, and the least weights."""

    def __init__(self, rows: list[tuple], opens: bool):
        """`rows`: (turn, initial, fault, gone, truncated) of at most `SEGMENT` rows; `opens`: no row of the conversation is before them."""
        turns = [row[0] for row in rows if row[0] is not None]
        self.turns = len(set(turns))
        self.turn = (min(turns), max(turns)) if turns else None
        self.faults = [sum(row[2] == fault for row in rows) for fault in ("blank", "duplicate", "truncated")]
        self.ends = (rows[0][1], rows[-1][1])
        self.illegal = sum(a[1] + b[1] not in _LEGAL for a, b in zip(rows, rows[1:]))
        self.places = width(len(rows))
        self.weights = segment([row[1:2] + row[3:5] for row in rows], (0,) if opens else range(_STATES))

    def followed_by(self, other: Part) -> Part:
        both = object.__new__(Part)
        both.turns = self.turns + other.turns
        if self.turn and other.turn:
            both.turns -= self.turn[1] == other.turn[0]
        both.turn = (self.turn or other.turn)[0:1] + (other.turn or self.turn)[1:2] if self.turn or other.turn else None
        both.faults = [a + b for a, b in zip(self.faults, other.faults)]
        both.ends = (self.ends[0], other.ends[1])
        both.illegal = self.illegal + other.illegal + (self.ends[1] + other.ends[0] not in _LEGAL)
        both.weights, both.places = joined(self.weights, self.places, other.weights, other.places)
        return both

    FIELDS = ("turns", "turn_from", "turn_to", "blank", "duplicate", "truncated", "initial_from", "initial_to", "illegal", "places", "weights")
    TYPES = (
        "turns long, turn_from long, turn_to long, blank long, duplicate long, truncated long, initial_from string, initial_to string, "
        "illegal long, places long, weights array<binary>"
    )

    def row(self) -> dict:
        turn = self.turn or (None, None)
        weights = [None if w is None else w.to_bytes((w.bit_length() + 7) // 8 or 1, "big") for row in self.weights for w in row]
        return dict(zip(self.FIELDS, (self.turns, *turn, *self.faults, *self.ends, self.illegal, self.places, weights)))

    @classmethod
    def of(cls, row: dict) -> Part:
        part = object.__new__(cls)
        part.turns, part.illegal, part.places = row["turns"], row["illegal"], row["places"]
        part.turn = None if row["turn_from"] is None else (row["turn_from"], row["turn_to"])
        part.faults = [row["blank"], row["duplicate"], row["truncated"]]
        part.ends = (row["initial_from"], row["initial_to"])
        weights = [None if w is None else int.from_bytes(w, "big") for w in row["weights"]]
        part.weights = [weights[at:at + _STATES] for at in range(0, _STATES ** 2, _STATES)]
        return part


class Joining:
    """Parts joined in order as a counter adds up bits, so equal stretches meet and few are held."""

    def __init__(self):
        self.held: list[tuple[int, Part]] = []

    def add(self, part: Part) -> None:
        size = 1
        while self.held and self.held[-1][0] <= size:
            before, first = self.held.pop()
            size, part = size + before, first.followed_by(part)
        self.held.append((size, part))

    def whole(self) -> Part:
        part = self.held.pop()[1]
        while self.held:
            part = self.held.pop()[1].followed_by(part)
        return part


def faults(rows: DataFrame) -> DataFrame:
    """The rows in pieces that are alike: conv_id, turn, role, digest, initial, blank, truncated, n and `again` (seen in an earlier turn)."""
    text = F.coalesce("text", F.lit(" "))
    shown = F.rtrim(text, F.lit(_BLANK))
    alike = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"),
        (shown == "").alias("blank"), (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("truncated"),
    ).groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.count(F.lit(1)).alias("n"))
    alike = stage(alike)
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = alike.groupBy(
        F.struct("conv_id").alias("whose"), F.col("role").alias("role_"), F.col("digest").alias("digest_")
    ).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places")).filter("places > 1")
    again = alike.join(
        first, alike["conv_id"].eqNullSafe(first["whose.conv_id"]) & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_")),
        "left",
    )
    return again.select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "blank", "truncated", "n",
        F.coalesce(place != F.col("first"), F.lit(False)).alias("again"),
    )


#: The order of the rows of a conversation: by turn, nulls first; of one turn by role, then by the text's digest.
ORDER = ("turn", "role", "digest")


def _parts(judged: DataFrame, rows: int) -> DataFrame:
    """conv_id, the order of the part's first row, and what `Part` holds: one row per conversation and range partition."""
    kind = judged.schema["conv_id"].dataType.simpleString()

    def copies(row: tuple) -> Iterator[tuple]:
        _, turn, _, _, initial, blank, truncated, n, again = row
        for copy in range(n):
            fault = "blank" if blank else "duplicate" if again or copy else "truncated" if truncated else ""
            yield turn, initial, fault, fault in ("blank", "duplicate"), fault == "truncated"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for at in range(0, batch.num_rows, 1024)
                  for row in zip(*(column.to_pylist() for column in batch.slice(at, 1024).columns)))
        out, fresh = [], False
        for conv, own in groupby(stream, itemgetter(0)):
            joining, held, first = Joining(), [], None
            opens = fresh  # only the first conversation of a partition may have begun in the one before
            for row in own:
                first = first or row
                for copy in copies(row):
                    held.append(copy)
                    if len(held) == rows:
                        joining.add(Part(held, opens))
                        held, opens = [], False
            if held:
                joining.add(Part(held, opens))
            out.append({"conv_id": conv, "turn": first[1], "role": first[2], "digest": first[3], **joining.whole().row()})
            fresh = True
            if len(out) == 512:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    shape = f"conv_id {kind}, turn long, role string, digest binary, {Part.TYPES}"
    schema = to_arrow_schema(T.StructType.fromDDL(shape))
    ordered = judged.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    return ordered.select("conv_id", *ORDER, "initial", "blank", "truncated", "n", "again").mapInArrow(run, shape)


#: What is said of a conversation.
FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def edits(rows: DataFrame, rows_at_once: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: one row per conversation of `rows`.

    `rows` has conv_id, turn, role and text; null roles and texts are one blank, a null `conv_id` is a conversation too. Rows
    stand by turn, nulls first; of one turn by role and then by the digest of the text, so repeated rows stand side by side. The
    first fault of a row counts: no character but blanks, role and text seen earlier, last such character not one of `.!?`. `gaps` are the
    turns missing between the least and the greatest; `illegal` counts neighbours whose initials are not su, ua or au. A role without
    letters has no legal initial. An empty table gives an empty result.
    """
    parts = _parts(stage(faults(rows)), rows_at_once)
    kind = parts.schema["conv_id"].dataType.simpleString()

    def conclude(group: pa.Table) -> pa.Table:
        found = group.to_pylist()
        found.sort(key=lambda p: (p["turn"] is not None, p["turn"] or 0, p["role"].encode(), p["digest"]))
        joining = Joining()
        for row in found:
            joining.add(Part.of(row))
        whole = joining.whole()
        cost, letters = audit(whole.weights, whole.places)
        gaps = whole.turn[1] - whole.turn[0] + 1 - whole.turns if whole.turn else 0
        return pa.table({
            "conv_id": group.column("conv_id").slice(0, 1),
            **{name: pa.array([value], pa.int64()) for name, value in zip(
                ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), (gaps, *whole.faults, whole.illegal, cost))},
            "audit": pa.array([letters], pa.string()),
        })

    return parts.groupBy("conv_id").applyInArrow(conclude, f"conv_id {kind}, {FIELDS}")


def _followed(letters: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired rows: `rows` (role, text) after the edits of `letters`."""
    rows, state = iter(rows), 0
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == 2 else "user"
        state = _NEXT[state][role[:1]]
        yield role, text


def repaired(rows: DataFrame, decided: DataFrame, fold=None) -> DataFrame:
    """conv_id, place, role, text: the conversations after their edits; `decided` has conv_id and audit.

    With `fold`, a class whose objects take (role, text) one by one and have a `result`, conv_id and that result instead.
    The rows of a conversation are read in order, one at a time.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    shape = f"conv_id {kind}, " + ("place long, role string, text string" if fold is None else "result string")
    text = F.coalesce("text", F.lit(" "))
    role = F.coalesce("role", F.lit(" "))
    stream = decided.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"),
    ).unionByName(rows.select(
        "conv_id", F.lit(1).alias("kind"), "turn", role.alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
    )).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)

    schema = to_arrow_schema(T.StructType.fromDDL(shape))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in zip(zip(*out), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (row for batch in batches for at in range(0, batch.num_rows, 256)
                 for row in zip(*(column.to_pylist() for column in batch.slice(at, 256).columns)))
        out, held = [], 0
        for conv, own in groupby(lines, itemgetter(0)):
            letters = next(own)[2]
            total = fold() if fold else None
            for place, (r, t) in enumerate(_followed(letters, (row[1:] for row in own))):
                if fold:
                    total.add(r, t)
                    continue
                out.append((conv, place, r, t))
                held += len(t)
                if held > 1 << 22:
                    yield batch_of(out)
                    out, held = [], 0
            if fold:
                out.append((conv, total.result))
            if len(out) >= 1024:
                yield batch_of(out)
                out, held = [], 0
        if out:
            yield batch_of(out)

    return stream.select("conv_id", "role", "text").mapInArrow(run, shape)


class Digest:
    """sha256 of `role:text` lines, joined by line ends."""

    def __init__(self):
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun = True

    @property
    def result(self) -> str:
        return self.hash.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """Faults as they occur, by crc32 of `conv_id:turn` modulo 20: 0 row lost, 1 text lost, 2 without `.!?`, 3 twice, 4 role user.

    Nulls are one blank here. Repeated rows are damaged alike.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    how = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    return conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), how.alias("how")).filter(
        "how <> 0"
    ).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id, what `edits` says and repaired_sha256 for every conversation of `conversations`; `rows` is what is left of them.

    A conversation without rows has zeros, no letters and the digest of nothing.
    """
    rows = stage(rows)
    decided = stage(edits(rows))
    digests = repaired(rows, decided.select("conv_id", "audit"), Digest).select(
        F.struct("conv_id").alias("whose"), F.col("result").alias("repaired_sha256"))
    named = decided.select(F.struct("conv_id").alias("whose"), *[c for c in decided.columns if c != "conv_id"])
    every = conversations.select(F.struct("conv_id").alias("whose")).distinct()
    return every.join(named.join(digests, "whose"), "whose", "left").select(
        F.col("whose.conv_id").alias("conv_id"),
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
