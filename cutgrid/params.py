"""Parameters of a run and the small texts users write them in."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Flag:
    """A fixed-width piece of the read prefix; `start` is 1-based."""

    name: str
    start: int
    width: int


def parse_pattern(pattern: str) -> list[Flag]:
    """`umi8bc8cs4` -> three adjacent flags of 8, 8 and 4 bases."""
    pieces = re.findall(r"([A-Za-z_]+)(\d+)", pattern)
    if not pieces or "".join(n + w for n, w in pieces) != pattern:
        raise ValueError(f"not a prefix pattern: {pattern!r}")
    flags, start = [], 1
    for name, width in pieces:
        flags.append(Flag(name, start, int(width)))
        start += int(width)
    return flags


@dataclass(frozen=True)
class BinTag:
    size: int
    step: int

    def __post_init__(self) -> None:
        if not 0 < self.step <= self.size:
            raise ValueError(f"a bin needs 0 < step <= size: {self.size}:{self.step}")

    @property
    def label(self) -> str:
        """The tag as it appears in file names, e.g. `1e+06_1e+05`."""
        return f"{_scientific(self.size)}_{_scientific(self.step)}"

    @property
    def grain(self) -> int:
        """Every bin of this tag is a whole number of slots this wide."""
        return math.gcd(self.size, self.step)


def _scientific(n: int) -> str:
    digits = str(n).rstrip("0")
    mantissa = digits[0] + ("." + digits[1:] if digits[1:] else "")
    text = f"{mantissa}e+{len(str(n)) - 1:02d}"
    return text if len(text) <= len(str(n)) else str(n)


def _whole(text: str) -> int:
    value = Decimal(text.strip())
    if value != int(value):
        raise ValueError(f"not a whole number of bases: {text!r}")
    return int(value)


def parse_bin_tags(text: str) -> list[BinTag]:
    """`1e6:1e5,25e3:25e3` -> sizes and steps as whole numbers."""
    return [BinTag(*(_whole(n) for n in tag.split(":"))) for tag in text.split(",") if tag.strip()]


def parse_chrom_tag(text: str) -> list[str]:
    """`22:X,Y` -> chr1..chr22, chrX, chrY."""
    upper, _, others = text.partition(":")
    names = [str(i) for i in range(1, int(upper) + 1)]
    names += [name.strip() for name in others.split(",") if name.strip()]
    return [f"chr{name}" for name in names]


def parse_outlier_tag(text: str, methods: Sequence[str]) -> tuple[str, float]:
    """`iqr:1.5` -> method and threshold."""
    method, _, threshold = text.partition(":")
    if method not in methods:
        raise ValueError(f"unknown outlier method {method!r}, expected one of {list(methods)}")
    return method, float(threshold)


# Defaults of the preprocessing steps.
MIN_PHRED = 30
MAX_LOW_SHARE = 0.2
MAX_SUBSTITUTIONS = 1
MIN_MAPQ = 30
MAX_SITE_DISTANCE = 20


@dataclass(frozen=True)
class LibraryParams:
    """Settings shared by all libraries of a run (enzyme, genome, thresholds)."""

    cut_seq: str = "GATC"
    pattern: str = "umi8bc8cs4"
    min_phred: int = MIN_PHRED
    max_low_share: float = MAX_LOW_SHARE
    max_subs: int = MAX_SUBSTITUTIONS
    min_mapq: int = MIN_MAPQ
    mito_names: tuple[str, ...] = ("chrM",)
    min_dist: int = MAX_SITE_DISTANCE

    @property
    def cs_len(self) -> int:
        return len(self.cut_seq)


@dataclass(frozen=True)
class ScoreParams:
    """Settings of the score stage; the defaults are the score tool's documented defaults."""

    bin_tags: str = "1e6:1e5,1e5:1e4"
    chromosome_wide: bool = False
    elongate_ter_bin: bool = False
    bed_outlier_tag: str = "chisq:0.01"
    score_outlier_tag: str = "iqr:1.5"
    normalize_by: str = "lib"
    site_domain: str = "separate"
    chrom_tag: str = "24:X,Y"
    tags: list[BinTag] = field(init=False)

    def __post_init__(self) -> None:
        if self.normalize_by not in ("lib", "chr"):
            raise ValueError("normalize_by is 'lib' or 'chr'")
        if self.site_domain not in ("separate", "universe"):
            raise ValueError("site_domain is 'separate' or 'universe'")
        object.__setattr__(self, "tags", parse_bin_tags(self.bin_tags))
