"""Encoding and decoding with a byte-fallback BPE model of the sentencepiece library.

No merge of the model crosses from a word into the blank before the next one (checked when the model is read), so
a text falls into units that are encoded apart: blanks and the word behind them. All new units of a batch are encoded
together: one flat array of symbols, in each round the best pair of every unit (lowest rank, leftmost), all
these pairs merged at once, finished units taken out, until no pair is left. Units beyond `LONG_UNIT` symbols would need a
round per merge; they are merged through a heap, by the same order.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from cutgrid.llm.common import map_texts, pieces

BLANK = "▁"
LONG_UNIT = 192
#: Units kept in memory by a task, and the longest ones that are.
CACHED, CACHED_LENGTH = 300_000, 64
_NONE = np.iinfo(np.int32).max


class Model:
    """Vocabulary of a model file as tables; only the pieces, their kinds and scores are taken from the library."""

    def __init__(self, path: str):
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.size = read.get_piece_size()
        names = [read.id_to_piece(i) for i in range(size)]
        self.special = {i for i in range(size) if read.is_control(i) or read.is_unknown(i)}
        self.unknown = read.unk_id()
        byte = [i for i in range(size) if read.is_byte(i)]
        plain = [i for i in range(size) if i not in self.special and not read.is_byte(i) and not read.is_unused(i)]
        if len(byte) != 256 or any(re.search(f"[^{BLANK}]{BLANK}", names[i]) for i in plain):
            raise ValueError("only models with byte fallback whose pieces keep blanks in front are covered")
        if read.encode(" a", out_type=str)[0][:2] != BLANK * 2 and read.encode(" a") == read.encode("a"):
            raise ValueError("only models that keep blanks and put one in front are covered")
        self.byte = np.full(256, -1, np.int32)
        self.surface: list[bytes] = [names[i].replace(BLANK, " ").encode() for i in range(size)]
        self.is_byte = np.zeros(size, bool)
        for i in byte:
            value = int(names[i][3:5], 16)
            self.byte[value], self.surface[i], self.is_byte[i] = i, bytes([value]), True
        for i in self.special:
            self.surface[i] = " ⁇ ".encode() if i == self.unknown else b""
        number = {names[i]: i for i in plain}
        self.char = np.full(0x110000, -1, np.int32)
        for name, i in number.items():
            if len(name) == 1:
                self.char[ord(name)] = i
        scores = np.array([read.get_score(i) for i in range(size)])
        self.rank = np.searchsorted(np.unique(-scores), -scores).astype(np.int32)
        pairs = {}
        for name, i in number.items():
            for cut in range(1, len(name)):
                left, right = number.get(name[:cut]), number.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = i
        self._spread(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32))
        self.line_alone = not any("\n" in names[i] for i in plain)
        alone = "\n" if self.line_alone else ""
        self.units = re.compile(f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+" + (f"|{alone}" if alone else ""))

    def _spread(self, keys: np.ndarray, values: np.ndarray) -> None:
        """The pairs as an open hash table, about an eighth full."""
        width = max(4, int(len(keys) * 8).bit_length())
        self.shift, self.mask = np.uint64(64 - width), (1 << width) - 1
        self.key, self.value = np.full(1 << width, -1, np.int64), np.full(1 << width, -1, np.int32)
        slot = self._slot(keys)
        while len(keys):
            _, first = np.unique(slot, return_index=True)
            first = first[self.key[slot[first]] == -1]
            self.key[slot[first]], self.value[slot[first]] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that a pair of symbols merges to, or -1; symbols below 0 are characters outside the vocabulary."""
        key = np.where((left >= 0) & (right >= 0), left * self.size + right, -2)
        slot = self._slot(key)
        held = self.key[slot]
        found = np.where(held == key, self.value[slot], -1)
        open_ = np.flatnonzero((held != key) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.key[slot[open_]]
            met = held == key[open_]
            found[open_[met]] = self.value[slot[open_[met]]]
            open_ = open_[~met & (held != -1)]
        return found

    def split(self, text: str) -> list[str]:
        """Units of a text; where single blanks and line ends part the words, without the pattern (it may give empty units too)."""
        if not text:
            return []
        marked = BLANK + text.replace(" ", BLANK)
        if "\0" in text or BLANK in text or text[0] == " " or "  " in text or not self.line_alone:
            return self.units.findall(marked)
        return marked.replace(BLANK, "\0" + BLANK).replace("\n", "\0\n\0").split("\0")

    def _symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        known = self.char[points]
        return np.where(known >= 0, known, -1 - points)

    def _bytes(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in place of symbols: a character outside the vocabulary becomes the pieces of its bytes."""
        strange = np.flatnonzero(symbols < 0)
        if not len(strange):
            return symbols.astype(np.int32), sizes
        parts = [self.byte[list(chr(-1 - s).encode("utf-8", "surrogatepass"))] for s in symbols[strange].tolist()]
        width = np.ones(len(symbols), np.int64)
        width[strange] = [len(part) for part in parts]
        ids = np.repeat(symbols, width)
        begin = (np.cumsum(width) - width)[strange]
        ids[np.concatenate([np.arange(a, a + len(part)) for a, part in zip(begin, parts)])] = np.concatenate(parts)
        return ids.astype(np.int32), np.add.reduceat(width, np.cumsum(sizes) - sizes)

    def _merge_rounds(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all units, and how many each unit has, once no pair is left."""
        own, finished = np.arange(len(sizes)), []
        unit = np.repeat(own, sizes)
        joined = np.full(len(symbols), -1, np.int64)
        same = np.flatnonzero(unit[:-1] == unit[1:])
        joined[same] = self._pairs(symbols[same], symbols[same + 1])
        rank = np.where(joined >= 0, self.rank[joined], _NONE)
        while len(own):
            best = np.minimum.reduceat(rank, np.cumsum(sizes) - sizes)
            each = np.repeat(best, sizes)
            at = np.flatnonzero((rank == each) & (joined >= 0))
            at = at[np.concatenate([[True], unit[at][1:] != unit[at][:-1]])] if len(at) else at
            symbols[at] = joined[at]
            done = best == _NONE
            finished.append((own[done], sizes[done], symbols[each == _NONE]))
            keep = each != _NONE
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            symbols, unit, joined, rank = symbols[keep], unit[keep], joined[keep], rank[keep]
            sizes, own = (sizes - 1)[~done], own[~done]
            # Only pairs with a merged symbol are new.
            last = place[(place + 1 < len(unit))]
            last = last[unit[last] == unit[last + 1]]
            before = place[place > 0] - 1
            before = before[unit[before] == unit[before + 1]]
            joined[place] = -1
            fresh = np.concatenate([last, before])
            joined[fresh] = self._pairs(symbols[fresh], symbols[fresh + 1])
            changed = np.concatenate([place, before])
            rank[changed] = np.where(joined[changed] >= 0, self.rank[joined[changed]], _NONE)
        owner, sizes, symbols = (np.concatenate(column) for column in zip(*finished))
        owners = np.argsort(np.repeat(owner, sizes), kind="stable")
        return symbols[owners], sizes[np.argsort(owner)]

    @cached_property
    def _single(self) -> tuple[dict[int, int], list[int]]:
        """The pairs and ranks for one look-up at a time."""
        used = self.key != -1
        return dict(zip(self.key[used].tolist(), self.value[used].tolist())), self.rank.tolist()

    def _merge_long(self, symbols: np.ndarray) -> np.ndarray:
        pairs, ranks = self._single
        symbol, size = symbols.tolist(), self.size
        count = len(symbol)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        joined = self._pairs(symbols[:-1], symbols[1:]).tolist()
        heap = [(ranks[j], i, symbol[i], symbol[i + 1], j) for i, j in enumerate(joined) if j >= 0]
        heapq.heapify(heap)

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else count
            if right < count and symbol[left] >= 0 and symbol[right] >= 0:
                j = pairs.get(symbol[left] * size + symbol[right])
                if j is not None:
                    heapq.heappush(heap, (ranks[j], left, symbol[left], symbol[right], j))

        while heap:
            _, left, a, b, j = heapq.heappop(heap)
            right = after[left]
            if right >= count or symbol[left] != a or symbol[right] != b:
                continue
            symbol[left], symbol[right], after[left] = j, None, after[right]
            if after[right] < count:
                before[after[right]] = left
            after[right] = count
            offer(before[left])
            offer(left)
        return np.array([s for s in symbol if s is not None], np.int64)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit as int32; none is empty."""
        long = [i for i, unit in enumerate(units) if len(unit) > LONG_UNIT]
        short = [unit for unit in units if len(unit) <= LONG_UNIT] if long else units
        found = []
        if short:
            ids, sizes = self._bytes(*self._merge_rounds(self._symbols("".join(short)), np.array(list(map(len, short)))))
            raw, end = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
            found = [raw[a:b] for a, b in zip([0, *end], end)]
        for i in long:
            symbols = self._merge_long(self._symbols(units[i]))
            found.insert(i, self._bytes(symbols, np.array([len(symbols)]))[0].tobytes())
        return found

    def decode(self, ids: list[int]) -> str:
        """Text of ids, as the library's decode: the blank put in front is taken off, bad bytes become U+FFFD."""
        raw = b"".join([self.surface[i] for i in ids])
        first = next((i for i in ids if i not in self.special or i == self.unknown), None)
        if first is not None and first != self.unknown and not self.is_byte[first] and raw[:1] == b" ":
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _repaired(raw)


def _repaired(raw: bytes) -> str:
    """One U+FFFD for every byte that begins no whole character."""
    out, at = [], 0
    while at < len(raw):
        for width in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class _Encoder:
    """Encodes texts; units met before are looked up, within `CACHED` of them."""

    def __init__(self, path: str):
        self.model, self.seen = Model(path), {"": b""}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split = [self.model.split(text or "") for text in texts]
        known = self.seen
        new = list({unit for units in split for unit in units if unit not in known})
        if len(known) + len(new) > CACHED:
            known = self.seen = {"": b""}
            new = list({unit for units in split for unit in units if unit})
        for first in range(0, len(new), 50_000):
            units = new[first:first + 50_000]
            known.update(zip(units, self.model.encode_units(units)))
        found = [b"".join(map(known.__getitem__, units)) for units in split]
        for unit in new:
            if len(unit) > CACHED_LENGTH:
                del known[unit]
        return found


def _pieces(texts: list[str | None], count: int = 256, chars: int = 4_000_000) -> Iterator[list[str | None]]:
    """Consecutive texts, so many and so long at most (a longer text comes alone)."""
    own, size = [], 0
    for text in texts:
        own.append(text)
        size += len(text or "")
        if len(own) >= count or size >= chars:
            yield own
            own, size = [], 0
    if own:
        yield own


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int): one row per row of `docs`.

    Null and empty texts have no ids. Repeated rows are encoded each, an empty table gives an empty result, only
    `doc_id` and `text` are read. The model file must be readable at the same path on every executor.
    """

    def begin():
        encoder = _Encoder(model_path)

        def work(texts: list[str | None]) -> list[pa.Array]:
            raw = [ids for part in _pieces(texts) for ids in encoder(part)]
            offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), np.int32)))]

        return work

    return map_texts(docs, begin, [T.StructField("ids", T.ArrayType(T.IntegerType()))])


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, text: the texts of the ids; null ids are an empty text."""
    schema = T.StructType([*tokens.select("doc_id", "ids").schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(model_path)
        for batch in pieces(batches):
            ids = batch.column(1)
            texts = [model.decode(own.as_py() or []) if own.is_valid else "" for own in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())], names=schema.fieldNames())

    return tokens.select("doc_id", "ids").mapInArrow(run, schema)
