"""Personal data in whole texts: patterns propose spans, checksums confirm them, context words adjust a score.

The base kinds (email, ip, card, phone) are always kept once their own test holds. Further kinds (iban, ssn) need a
score of at least `ACCEPT`, made of what the pattern is worth by itself, what its checksum adds and what a
context word nearby adds. Every pattern reads a text once: runs are matched possessively or from their
separator, so long runs of digits or letters cost no retries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from cutgrid.llm.common import map_texts

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
ACCEPT = 0.6
#: Code points before and after a span in which a context word counts.
NEARBY = 60
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Characters of an IBAN by country (ISO 13616 registry). Other codes are tried at every end the pattern allows.
_IBAN_SIZES = {
    code: size for size, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items() for code in codes.split()
}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
#: Worth of the pattern, of a passed checksum, of a context word, and the context words of a kind.
_SCORES = {
    "email": (0.9, 0.0, 0.1, "mail|contact|kontakt|courriel|correo|write"),
    "ip": (0.7, 0.0, 0.3, r"ip|host|server|addr\w*"),
    "card": (0.3, 0.5, 0.2, r"card|karte|carte|tarjeta|visa|credit|kredit\w*"),
    "phone": (0.6, 0.0, 0.4, r"phone|tel\w*|call|mobile|fax|handy"),
    "iban": (0.1, 0.6, 0.3, r"iban|bank|konto|account|compte|cuenta"),
    "ssn": (0.3, 0.0, 0.5, r"ssn|social|security|taxpayer"),
}
_CONTEXT = {kind: re.compile(rf"\b(?:{words})\b", re.I) for kind, (_, _, _, words) in _SCORES.items()}

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The first four characters go to the end, letters count 10 to 35, the remainder by 97 is 1."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The pattern takes groups that follow an IBAN with it, so its length comes from the country, and the search goes on behind it."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 4
        wanted = _IBAN_SIZES.get(m[0][:2])
        for end in [m.end(), *(m.start() + i for i in range(len(m[0]) - 1, 0, -1) if m[0][i] == " ")]:
            bare = text[m.start():end].replace(" ", "")
            if (len(bare) == wanted if wanted else 15 <= len(bare) <= 34) and mod97(bare):
                yield m.start(), end
                at = end
                break


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
            at = text.find("@", end)
        else:
            end = at + 1
            at = text.find("@", end)


def _matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """kind, start, end and whether a checksum confirmed it; proposals that fail their own test are left out."""
    for start, end in _emails(text):
        yield "email", start, end, False
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.groups()):
            yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end(), False
    for start, end in _ibans(text):
        yield "iban", start, end, True
    if "-" in text:
        for m in _SSN.finditer(text):
            yield "ssn", m.start(), m.end(), False


def find(text: str) -> list[tuple[int, int, int, float]]:
    """(start, number of the kind, end, score) of every span that stays, in order."""
    spans = []
    for kind, start, end, confirmed in _matches(text):
        worth, checksum, context, _ = _SCORES[kind]
        near = text[max(0, start - NEARBY):start] + " " + text[end:end + NEARBY]
        score = worth + checksum * confirmed + context * bool(_CONTEXT[kind].search(near))
        if kind in BASE or score >= ACCEPT:
            spans.append((start, KINDS.index(kind), end, round(score, 3)))
    return sorted(spans)


def _begin():
    def work(texts: list[str | None]) -> list[pa.Array]:
        found = [find(text) if text else [] for text in texts]
        return [pa.array(
            [[{"kind": KINDS[k], "start": a, "end": b, "score": s} for a, k, b, s in spans] for spans in found],
            pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])),
        )]

    return work


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans (kind, start, end, score) by start and then kind: one row per row of `docs`.

    Positions are code points, end exclusive. Null and empty text have no spans, repeated rows are scanned each, an
    empty table gives an empty result, ids may be null, and only `doc_id` and `text` are read.
    """
    span = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
    ])
    return map_texts(docs, _begin, [T.StructField("spans", T.ArrayType(span))])
