"""Language of whole texts by interpolated Kneser-Ney models of characters, one per language.

A text is its words (runs of letters, lower case), a word the characters between two boundary marks; the models predict each
character and the closing mark from up to `ORDER - 1` before it in the word. Counting, continuation counts, discounts
and weights are aggregations over a sample of the labelled rows; the tables go out as sorted hash arrays, one
per order, with a column for each language. The answer is the language of lowest cross-entropy a symbol. A text is
rejected if that is further above what texts of its language have than `REJECT` deviations, which widen for short texts,
and above what texts get whose own language is left out: of the lowest cross-entropy among the other languages a low
quantile, and never more than characters by themselves have.

The sample has at most `SAMPLE_ROWS` rows a language, each with its whole text. The
tables hold every sequence of the sample, one entry per sequence and language, and what one language predicts does not depend on the
others. They go out in blocks of languages of at most `ENTRIES` entries, so what the driver and a task hold is bounded for any number
of languages; the answer is the minimum over all blocks.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cutgrid.functions.sizing import stage
from cutgrid.llm.common import map_texts, with_digest, without

ORDER = 5
#: Labelled rows of a language that are learnt from, each with its whole text.
SAMPLE_ROWS = 600
#: Every so many sampled rows one is kept from counting and used to calibrate the rejection.
CALIBRATE = 5
REJECT = 8.0
#: Share of the texts of left-out languages that may pass for the nearest other language.
FOREIGN = 0.05
UNKNOWN = "und"
#: Entries of the models that are sent out at once, about 30 bytes each.
ENTRIES = 1 << 21
_BEGIN, _END = "\x02", "\x03"


def _marks() -> str:
    """All combining marks, as ranges of a character class."""
    found = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith("M")]
    starts = [c for c, before in zip(found, [-2, *found]) if c != before + 1]
    ends = [c for c, after in zip(found, [*found[1:], -2]) if c != after - 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


#: A letter and what follows of letters and of the marks that belong to them, as vowels do in many scripts.
_PLAIN = re.compile(r"[^\W\d_]+")
_WORD = re.compile(rf"[^\W\d_]+(?:[{_marks()}]+[^\W\d_]*)*")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CACHED = 300_000


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters with their marks; none if the text has no letter at all."""
    lowered = text.lower() if text else ""
    try:  # the quick way to know that there are no marks
        lowered.encode("latin-1")
        found = _PLAIN.findall(lowered)
    except UnicodeEncodeError:
        found = _WORD.findall(lowered)
    return found if any(c.isalpha() for word in found for c in word) else []


def _step(value: np.ndarray, code: np.ndarray) -> np.ndarray:
    value = (value ^ (code.astype(np.uint64) + np.uint64(1))) * _MIX
    return value ^ (value >> np.uint64(29))


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Tables:
    """The models of some languages. `keys[n]`: sorted hashes of the sequences of n + 1 characters. The entries of key i are
    `first[n][i]` to `first[n][i + 1]`: `lang[n]` is the language, `seen[n]` the discounted probability of the last character,
    `weight[n]` the weight of the shorter model behind it as a context."""

    languages: list[str]
    keys: list[np.ndarray]
    first: list[np.ndarray]
    lang: list[np.ndarray]
    seen: list[np.ndarray]
    weight: list[np.ndarray]
    base: np.ndarray

    def _entries(self, n: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of all `rows`, and which of the rows each belongs to."""
        first, count = self.first[n][rows], self.first[n][rows + 1] - self.first[n][rows]
        which = np.repeat(np.arange(len(rows)), count)
        return which, np.arange(len(which)) + np.repeat(first - (np.cumsum(count) - count), count)

    def log_probability(self, units: list[str]) -> np.ndarray:
        """Natural log of each word's probability (rows) in each language (columns)."""
        codes = _codes([_BEGIN + unit + _END for unit in units])
        sizes = np.array([len(unit) + 2 for unit in units])
        start = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - np.repeat(start, sizes)
        value = np.zeros(len(codes), np.uint64)
        chance = np.repeat(self.base[None, :], len(codes), axis=0)
        shorter = None
        for n in range(len(self.keys)):
            own = np.flatnonzero(place >= n)
            value[own] = _step(value[own], codes[own - n])
            at = np.minimum(np.searchsorted(self.keys[n], value[own]), len(self.keys[n]) - 1)
            row = np.full(len(codes), -1, np.int64)
            row[own] = np.where(self.keys[n][at] == value[own], at, -1) if len(self.keys[n]) else -1
            if n:
                context = shorter[np.maximum(np.arange(len(codes)) - 1, 0)]
                behind = np.flatnonzero((place >= n) & (context >= 0))
                which, entry = self._entries(n - 1, context[behind])
                chance[behind[which], self.lang[n - 1][entry]] *= self.weight[n - 1][entry]
            met = np.flatnonzero(row >= 0)
            which, entry = self._entries(n, row[met])
            chance[met[which], self.lang[n][entry]] += self.seen[n][entry]
            shorter = row
        logs = np.log(np.maximum(chance, 1e-12))
        logs[start] = 0
        return np.add.reduceat(logs, start, axis=0)


    def single(self, at: int, characters: int) -> float:
        """Cross-entropy that single characters have by themselves in a language, of all `characters` met in any."""
        chance = np.full(characters, self.base[at])
        own = self.lang[0] == at
        chance[np.repeat(np.arange(len(self.keys[0])), np.diff(self.first[0]))[own]] += self.seen[0][own]
        return -(chance * np.log(chance)).sum() / chance.sum()


@dataclass
class Models:
    """The models of all languages, in blocks of at most `ENTRIES` entries (or of one language); only one is held at a time.

    `grams` is the staged table of all entries, `alphabet` the number of characters met, and one for those never met."""

    grams: DataFrame
    blocks: list[list[str]]
    alphabet: int
    order: int
    mean: np.ndarray
    deviation: np.ndarray
    symbols: np.ndarray
    foreign: np.ndarray

    @property
    def languages(self) -> list[str]:
        return [name for block in self.blocks for name in block]

    def tables(self, block: int) -> Tables:
        names = self.blocks[block]
        table = self.grams.filter(F.col("lang").isin(names)).toArrow().to_pandas()
        column = table["lang"].map({lang: i for i, lang in enumerate(names)}).to_numpy()
        base, root = np.ones(len(names)), table["n"].to_numpy() == 0
        base[column[root]] = table["weight"].to_numpy()[root]
        tables = Tables(names, [], [], [], [], [], base / self.alphabet)
        for n in range(1, self.order + 1):
            own = table["n"].to_numpy() == n
            text = table["gram"].to_numpy()[own].tolist()
            codes = _codes(text).reshape(-1, n)
            value = np.zeros(len(text), np.uint64)
            for back in range(n):
                value = _step(value, codes[:, n - 1 - back])
            keys, row = np.unique(value, return_inverse=True)
            place = np.lexsort((column[own], row))
            tables.keys.append(keys)
            tables.first.append(np.searchsorted(row[place], np.arange(len(keys) + 1)))
            tables.lang.append(column[own][place].astype(np.int32))
            tables.seen.append(table["seen"].to_numpy()[own][place])
            tables.weight.append(table["weight"].to_numpy()[own][place])
        return tables

    def log_probability(self, units: list[str]) -> np.ndarray:
        return np.concatenate([self.tables(block).log_probability(units) for block in range(len(self.blocks))], axis=1)


class _Scorer:
    """Sums of log-probabilities over the words of texts; words met before are looked up."""

    def __init__(self, models: Tables):
        self.models, self.row, self.table = models, {}, np.zeros((0, len(models.languages)))

    def _learn(self, new: list[str]) -> None:
        if len(self.row) + len(new) > _CACHED:
            raise OverflowError
        for first in range(0, len(new), 20_000):
            part = new[first:first + 20_000]
            self.row.update(zip(part, range(len(self.row), len(self.row) + len(part))))
            self.table = np.concatenate([self.table, self.models.log_probability(part)])

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sums for each language, and the symbols that were predicted."""
        every = set().union(*texts) if texts else set()
        new = list(every.difference(self.row))
        if len(self.row) + len(new) > _CACHED:
            self.row, self.table, new = {}, self.table[:0], list(every)
        long = [word for word in new if len(word) > 64]
        if len(new) > _CACHED:
            half = len(texts) // 2
            if half:
                (a, m), (b, n) = self(texts[:half]), self(texts[half:])
                return np.concatenate([a, b]), np.concatenate([m, n])
            sums = np.zeros((1, len(self.models.languages)))
            counts = Counter(texts[0])
            for first in range(0, len(new), 20_000):
                part = new[first:first + 20_000]
                sums += np.array([counts[w] for w in part]) @ self.models.log_probability(part)
            return sums, np.array([sum(len(w) + 1 for w in texts[0])])
        self._learn(new)
        sums = np.zeros((len(texts), len(self.models.languages)))
        symbols = np.zeros(len(texts), np.int64)
        for i, own in enumerate(texts):
            if own:
                sums[i] = self.table[np.fromiter(map(self.row.__getitem__, own), np.int64, len(own))].sum(axis=0)
                symbols[i] = sum(map(len, own)) + len(own)
        if long:
            self.row, self.table = {}, self.table[:0]
        return sums, symbols


def _counted(sample: DataFrame, order: int) -> DataFrame:
    """lang, gram, n, raw: how often each sequence of up to `order` characters ends at a predicted symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, Counter()).update(words(text))
            for lang, found in by_lang.items():
                grams: Counter = Counter()
                for word, count in found.items():
                    marked = _BEGIN + word + _END
                    for end in range(2, len(marked) + 1):
                        for begin in range(max(0, end - order), end):
                            grams[marked[begin:end]] += count
                if grams:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(grams), pa.string()), pa.array(list(grams), pa.string()),
                        pa.array([len(g) for g in grams], pa.int32()), pa.array(list(grams.values()), pa.int64()),
                    ], names=["lang", "gram", "n", "raw"])

    parts = sample.select("lang", "text").mapInArrow(run, "lang string, gram string, n int, raw long")
    return parts.groupBy("lang", "gram", "n").agg(F.sum("raw").alias("raw"))


def _weighted(counted: DataFrame, order: int) -> DataFrame:
    """lang, gram, n, seen, weight: the interpolated Kneser-Ney tables."""
    counted = stage(counted)
    before = counted.filter("n > 1").groupBy(
        "lang", F.expr("substring(gram, 2)").alias("gram"), (F.col("n") - 1).alias("n")
    ).agg(F.count(F.lit(1)).alias("before"))
    whole = (F.col("n") == order) | F.col("gram").startswith(_BEGIN)
    adjusted = counted.join(before, ["lang", "gram", "n"], "left").select(
        "lang", "gram", "n", F.when(whole, F.col("raw")).otherwise(F.coalesce("before", F.lit(1))).alias("c")
    )
    ones, twos = F.sum((F.col("c") == 1).cast("double")), F.sum((F.col("c") == 2).cast("double"))
    discount = adjusted.groupBy("lang", "n").agg(F.least(F.lit(0.95), F.greatest(
        F.lit(0.1), F.coalesce(F.try_divide(ones, ones + 2 * twos), F.lit(0.5)))).alias("discount"))
    context = F.expr("substring(gram, 1, n - 1)")
    totals = adjusted.groupBy("lang", "n", context.alias("context")).agg(
        F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds")
    ).join(discount, ["lang", "n"])
    seen = adjusted.withColumn("context", context).join(totals, ["lang", "n", "context"]).select(
        "lang", "gram", "n", "c", (F.greatest(F.col("c") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("seen")
    )
    weight = totals.select(
        "lang", F.col("context").alias("gram"), (F.col("n") - 1).alias("n"),
        (F.col("discount") * F.col("kinds") / F.col("total")).alias("weight"),
    )
    return seen.join(weight, ["lang", "gram", "n"], "full").select(
        "lang", "gram", "n", F.coalesce("seen", F.lit(0.0)).alias("seen"),
        F.coalesce("weight", F.lit(1.0)).alias("weight"),
    )


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """lang, text, calibrate: at most `rows` labelled rows a language that are not held out, spread by a hash of id and text."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("h"),
    )
    counts = stage(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("labelled")))
    # Twice the wanted share by hash first, so that few rows meet in the window that takes exactly as many.
    few = labelled.join(counts, "lang").filter(
        F.pmod("h", F.lit(1 << 20)) < F.greatest(F.lit(64.0), F.lit(2.0 * rows * (1 << 20)) / F.col("labelled"))
    )
    number = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return few.withColumn("number", number).filter(F.col("number") <= rows).select(
        "lang", "text", (F.col("number") % CALIBRATE == 0).alias("calibrate")
    )


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, order: int = ORDER, entries: int = ENTRIES) -> Models:
    """Models of all languages in `lang`; without any labelled text there are none."""
    sample = stage(sampled(docs, rows))
    grams = stage(_weighted(_counted(sample.filter("not calibrate"), order), order).select("lang", "gram", "n", "seen", "weight"))
    blocks: list[list[str]] = []
    held = 0
    for row in grams.groupBy("lang").agg(F.count(F.lit(1)).alias("entries")).orderBy("lang").collect():
        if not blocks or held + row["entries"] > entries:
            blocks, held = [*blocks, []], 0
        blocks[-1].append(row["lang"])
        held += row["entries"]
    none = np.zeros(0)
    if not blocks:
        return Models(grams, [], 1, order, none, none, none, none)
    alphabet = grams.filter("n = 1").select("gram").distinct().count() + 1
    return _calibrated(Models(grams, blocks, alphabet, order, none, none, none, none), sample.filter("calibrate"))


def _calibrated(models: Models, sample: DataFrame) -> Models:
    """Of each language's own texts: mean and deviation of the cross-entropy, and mean number of symbols. Beside them, of the
    texts of other languages that would get this one if their own were not learnt, the `FOREIGN` quantile of the
    cross-entropy; the entropy of the language's single characters bounds it, so characters never seen do not raise it."""
    languages = models.languages
    count = len(languages)
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("doc_id")).cast("int")
    nearest = F.array_min(F.transform("entropies", lambda e, i: F.when(i != number - 1, e)))
    own = stage(_scored(sample.select(F.col("lang").alias("doc_id"), "text"), models).filter("symbols > 0").select(
        "doc_id", "symbols", F.element_at("entropies", number).alias("own"), nearest.alias("nearest"),
        F.array_position("entropies", nearest).cast("int").alias("taken_for"),
    ))
    found = own.groupBy("doc_id").agg(
        F.avg("own").alias("mean"), F.stddev_pop("own").alias("deviation"), F.avg("symbols").alias("symbols"),
    ).collect()
    left_out = own.filter("nearest IS NOT NULL").rollup("taken_for").agg(F.percentile("nearest", F.lit(FOREIGN)).alias("low")).collect()
    low = {row["taken_for"]: row["low"] for row in left_out}
    # A language without calibration texts rejects nothing.
    mean, deviation, symbols, foreign = (np.full(count, value) for value in (1e9, 0.0, 0.0, 0.0))
    single: list[float] = []
    for block in range(len(models.blocks)):
        tables = models.tables(block)
        single += [tables.single(at, models.alphabet - 1) for at in range(len(tables.languages))]
    for row in found:
        at = languages.index(row["doc_id"])
        mean[at], deviation[at], symbols[at] = row["mean"], max(row["deviation"], 0.02), row["symbols"]
        foreign[at] = min(low.get(at + 1, low.get(None)) or np.inf, single[at])
    return replace(models, mean=mean, deviation=deviation, symbols=symbols, foreign=foreign)


def _scored(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, entropies (by language, nats a symbol), symbols: one row per row of `docs`.

    With several blocks of languages each is sent out by itself, its entropies are staged, and they are put together by id and text.
    """
    spark, several = docs.sparkSession, len(models.blocks) > 1

    def begin(shared):
        def start():
            scorer = _Scorer(shared.value)

            def work(texts: list[str | None]) -> list[pa.Array]:
                entropies, symbols = [], []
                for first in range(0, len(texts), 256):
                    sums, count = scorer([words(text) for text in texts[first:first + 256]])
                    entropies += (-sums / np.maximum(count, 1)[:, None]).tolist()
                    symbols += count.tolist()
                columns = [pa.array(entropies, pa.list_(pa.float64())), pa.array(symbols, pa.int64())]
                if several:
                    columns.append(pa.array([hashlib.sha256((text or "").encode()).hexdigest() for text in texts], pa.string()))
                return columns

            return work

        return start

    fields = [T.StructField("entropies", T.ArrayType(T.DoubleType())), T.StructField("symbols", T.LongType())]
    if not several:
        tables = models.tables(0) if models.blocks else Tables([], [], [], [], [], [], np.zeros(0))
        return map_texts(docs, begin(spark.sparkContext.broadcast(tables)), fields)
    every = None
    for block in range(len(models.blocks)):
        shared = spark.sparkContext.broadcast(models.tables(block))
        one = stage(map_texts(docs, begin(shared), [*fields, T.StructField("digest", T.StringType())]).withColumn("block", F.lit(block)))
        shared.destroy()
        every = one if every is None else every.unionByName(one)
    together = every.groupBy("doc_id", "digest", "block").agg(
        F.first("entropies").alias("entropies"), F.first("symbols").alias("symbols"), F.count(F.lit(1)).alias("rows")
    ).groupBy("doc_id", "digest").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "entropies"))), lambda own: own["entropies"])).alias("entropies"),
        F.first("symbols").alias("symbols"), F.first("rows").alias("rows"),
    )
    return together.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select("doc_id", "entropies", "symbols")


def identify(docs: DataFrame, models: Models, reject: float = REJECT) -> DataFrame:
    """doc_id, lang_pred, score, entropy, symbols, rejected: one row per row of `docs`.

    Texts that are null or have no letter are `und` with score 0, and so is every text if there are no models; these are
    rejected too. Of equal entropies the first language in order is taken. `score` is the share of the answer among the
    languages at the text's likelihood. Repeated rows are scored each, an empty table gives an empty result.
    """
    scored = _scored(docs, models)
    known = (F.col("symbols") > 0) & F.lit(bool(models.languages))
    best = F.array_min("entropies")
    at = F.array_position("entropies", best).cast("int")

    def of(values: np.ndarray) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), at)

    if not models.languages:
        return scored.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"),
            "symbols", F.lit(True).alias("rejected"),
        )
    others = F.aggregate("entropies", F.lit(0.0), lambda total, e: total + F.exp((best - e) * F.col("symbols")))
    usual = of(models.mean) + reject * of(models.deviation) * F.sqrt(1 + of(models.symbols) / F.col("symbols"))
    limit = F.greatest(usual, of(models.foreign))
    return scored.select(
        "doc_id", F.when(known, F.element_at(F.array(*map(F.lit, models.languages)), at)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, 1 / others).otherwise(0.0).alias("score"), F.when(known, best).alias("entropy"), "symbols",
        F.when(known, best > limit).otherwise(True).alias("rejected"),
    )


def drop_rejected(docs: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of `docs` whose text is not rejected, with all their columns; rows that share an id, or have none, are told apart by text."""
    return without(docs, identify(with_digest(docs), fit(docs), reject).filter("rejected"))
