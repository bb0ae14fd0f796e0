"""Secrets in whole texts, with DataFrame functions only.

Patterns give the base spans. Beside them, long runs of token characters are candidates: a window of `WINDOW`
characters slides over each, its Shannon entropy follows from counts that change by one character in and one out,
and a candidate whose best window reaches the limit of its character class becomes a further span. Windows within a
base span do not count, and what the allow list knows is cut out of a candidate before its windows are judged, so
neither hides what stands beside it. Spans are code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 20
#: Classes from narrow to wide: symbols, whether the class needs a digit and a letter, bits a character from which it counts.
CLASSES = (
    ("hexadecimal", "^[0-9a-fA-F]+$", 3.0),
    ("alphanumeric", "^[0-9A-Za-z]+$", 3.6),
    ("base64", "^[0-9A-Za-z+/=_-]+$", 3.9),
)
#: What is cut out of a candidate, and candidates that are no secret as a whole.
ALLOWED = "(?i:example|sample|dummy|placeholder|changeme|redacted)|(.)\\1{7}|(?i:0123456789|1234567890|abcdefghij)"
ALLOWED_WHOLE = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ASSIGN = "((?i)password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs that are cut at the wanted length find what unlimited runs with a later length test find: a run that is too short holds no other.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = f"[A-Za-z0-9+/=_-]{{{WINDOW},}}"
KINDS = ("assign", "access", "hex", "entropy")
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
_BLOCK = 512


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, also where a lambda inside `body` uses it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(steps: Column) -> Column:
    """start, end and text of each hit, from structs of (gap before it, its text), in two levels of blocks.

    An array that grows by one element is copied each time, so positions are first summed up per block.
    """

    def span(at: Column, step: Column) -> Column:
        begin = at + step["gap"]
        return F.struct(begin.alias("start"), (begin + F.length(step["hit"])).alias("end"), step["hit"].alias("hit"))

    none = "array<struct<start:int,end:int,hit:string>>"

    def spans(at: Column, block: Column) -> Column:
        return F.aggregate(
            block, F.struct(at.alias("at"), F.array().cast(none).alias("spans")),
            lambda seen, step: _let(span(seen["at"], step), lambda new: F.struct(
                new["end"].alias("at"), F.concat(seen["spans"], F.array(new)).alias("spans"))),
        )["spans"]

    def width(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda total, step: total + step["gap"] + F.length(step["hit"]))

    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
        lambda i: F.slice(steps, i * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def placed(blocks: Column) -> Column:
        starts = F.aggregate(blocks, F.array(F.lit(0)), lambda at, block: F.concat(
            at, F.array(F.element_at(at, -1) + width(block))))
        return F.flatten(F.zip_with(F.slice(starts, F.lit(1), F.size(blocks)), blocks, spans))

    return F.when(F.size(steps) == 0, F.array().cast(none)).otherwise(_let(cut, placed))


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of `pattern` as an array of (start, end, hit), in order."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits,
        lambda before, hit: F.struct(F.length(before).alias("gap"), hit.alias("hit")),
    )
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return F.when(text.rlike(pattern), _let(steps, _running)).otherwise(empty)


def window_entropy(candidate: Column) -> Column:
    """Highest Shannon entropy, in bits a character, of any `WINDOW` consecutive characters."""
    codes = F.transform(
        F.filter(F.split(candidate, ""), lambda c: c != ""), lambda c: F.instr(F.lit(_SYMBOLS), c)
    )
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    moves = _let(codes, lambda c: F.zip_with(
        c, F.concat(F.array_repeat(F.lit(0), WINDOW), c), lambda come, gone: F.struct(
            F.coalesce(come, F.lit(0)).alias("come"), F.coalesce(gone, F.lit(0)).alias("gone"))))

    def entered(state: Column, code: Column, by: int) -> Column:
        """The counts and their sum of c log2 c after a character came (1) or went (-1); code 0 is none."""
        now = F.element_at(state["counts"], F.greatest(code, F.lit(1)))
        changed = F.struct(
            F.transform(state["counts"], lambda c, i: F.when(i == code - 1, c + by).otherwise(c)).alias("counts"),
            (state["sum"] + F.element_at(weight, now + by + 1) - F.element_at(weight, now + 1)).alias("sum"),
            state["seen"].alias("seen"), state["best"].alias("best"),
        )
        return F.when(code > 0, changed).otherwise(state)

    def moved(state: Column, move: Column) -> Column:
        return _let(entered(state, move["gone"], -1), lambda left: _let(entered(left, move["come"], 1), lambda both: F.struct(
            both["counts"].alias("counts"), both["sum"].alias("sum"),
            (both["seen"] + F.when(move["come"] > 0, 1).otherwise(0)).alias("seen"),
            F.when((move["come"] > 0) & (both["seen"] + 1 >= WINDOW),
                   F.greatest(both["best"], math.log2(WINDOW) - both["sum"] / WINDOW)).otherwise(both["best"]).alias("best"),
        )))

    start = F.struct(
        F.array_repeat(F.lit(0), len(_SYMBOLS)).alias("counts"), F.lit(0.0).alias("sum"),
        F.lit(0).alias("seen"), F.lit(0.0).alias("best"),
    )
    return F.aggregate(moves, start, moved)["best"]


def _limit(candidate: Column) -> Column:
    limit = F.lit(None).cast("double")
    for _, symbols, bits in reversed(CLASSES):
        limit = F.when(candidate.rlike(symbols), F.lit(bits)).otherwise(limit)
    return F.when(candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]"), limit)


def _outside(candidate: Column, base: Column) -> Column:
    """The parts of a candidate whose windows lie in no base span: the gaps between the spans, each with the `WINDOW - 1`
    characters on either side from which a window still reaches into it."""
    own = F.array_sort(F.filter(base, lambda b: (b["start"] < candidate["end"]) & (candidate["start"] < b["end"])))
    start = F.struct(candidate["start"].alias("at"), F.array().cast("array<string>").alias("parts"))

    def part(begin: Column, end: Column) -> Column:
        low = F.greatest(begin - (WINDOW - 1), candidate["start"])
        high = F.least(end + (WINDOW - 1), candidate["end"])
        return F.when(begin < end, F.array(F.substring(candidate["hit"], low - candidate["start"] + 1, high - low))).otherwise(
            F.array().cast("array<string>"))

    def passed(state: Column, b: Column) -> Column:
        return F.struct(
            F.greatest(state["at"], b["end"]).alias("at"), F.concat(state["parts"], part(state["at"], b["start"])).alias("parts"))

    return F.when(F.size(own) == 0, F.array(candidate["hit"])).otherwise(F.aggregate(
        own, start, passed, lambda state: F.concat(state["parts"], part(state["at"], candidate["end"]))))


def _secret(candidate: Column, base: Column) -> Column:
    """Class first, then base spans and the allow list, and the windows only for what is left."""
    hit = candidate["hit"]
    left = F.filter(
        F.flatten(F.transform(_outside(candidate, base), lambda part: F.split(part, ALLOWED, -1))), lambda part: F.length(part) >= WINDOW)
    return F.when(_limit(hit).isNotNull() & ~hit.rlike(ALLOWED_WHOLE), F.exists(
        left, lambda part: window_entropy(part) >= _limit(hit))).otherwise(False)


def _written(spans: Column) -> Column:
    ordered = F.array_sort(spans)
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base, spans: one row per row of `docs`.

    `base` and `spans` hold kind:start:end, comma-joined, by start and then kind. Null text is empty and has no
    spans; equal starts are ordered by kind, repeated rows are scanned each, an empty table gives an empty result, and
    only `doc_id` and `text` are read. No limit on length: work grows with the text and the candidates in it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    assign = F.filter(located(F.col("text"), ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], "^" + ASSIGN + "$", 2)) >= 6)
    found = rows.select(
        "doc_id", assign.alias("assign"),
        F.when(F.contains("text", F.lit("AKIA")), located(F.col("text"), ACCESS)).otherwise(
            F.array().cast("array<struct<start:int,end:int,hit:string>>")).alias("access"),
        located(F.col("text"), HEX).alias("hex"), located(F.col("text"), CANDIDATE).alias("candidates"),
    )
    base_spans = F.concat(*[_of_kind(F.col(kind), i) for i, kind in enumerate(KINDS[:3])])
    found = found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]], base_spans.alias("base"), "candidates"
    )
    more = F.when(F.size("candidates") > 0, _let(F.col("base"), lambda base: F.filter(
        F.col("candidates"),
        lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])) & _secret(s, base),
    ))).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base", _of_kind(more, 3).alias("entropy")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.size("entropy").cast("long").alias("n_entropy"),
        _written(F.col("base")).alias("base"), _written(F.concat("base", "entropy")).alias("spans"),
    )
