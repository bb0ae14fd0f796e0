"""Column expressions: all built-in, all inside generated code where Spark allows it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

PHRED_OFFSET = 33


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_token(c: Column | str, sep: str = " ") -> Column:
    """The text before the first separator."""
    return F.substring_index(col(c), sep, 1)


def base_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def dir_name(path: Column | str) -> Column:
    return F.regexp_replace(col(path), "/[^/]*$", "")


def library_id(file_name: Column | str, sep: str = "_") -> Column:
    """Library of a file: its base name up to the first separator."""
    return first_token(base_name(file_name), sep)


def phred(char: Column | str) -> Column:
    """Quality of one character."""
    return F.ascii(col(char)) - F.lit(PHRED_OFFSET)


def low_quality_bases(qual: Column | str, min_phred: int) -> Column:
    """How many characters of a quality text stand for less than `min_phred`."""
    low = "".join(chr(PHRED_OFFSET + q) for q in range(min_phred))
    return F.length(col(qual)) - F.length(F.translate(col(qual), low, ""))


def substitutions(a: Column | str, b: Column | str, width: int) -> Column:
    """Positions at which two texts of `width` letters differ; null when a length is not `width`."""
    a, b = col(a), col(b)
    differs = [
        (F.substring(a, i, 1) != F.substring(b, i, 1)).cast("int") for i in range(1, width + 1)
    ]
    count = reduce(lambda x, y: x + y, differs)
    return F.when((F.length(a) == width) & (F.length(b) == width), count)


def reference_length(cigar: Column | str) -> Column:
    """Bases of the reference that an alignment spans."""
    lengths = F.regexp_extract_all(col(cigar), F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda acc, n: acc + n.cast("long"))


def has_bits(flags: Column | str, bits: int) -> Column:
    """Whether any of the given alignment flag bits is set."""
    return col(flags).bitwiseAND(F.lit(bits)) != 0


def percent(part: Column | str, whole: Column | str) -> Column:
    """Share in percent; null for an empty whole."""
    return F.try_divide(col(part) * F.lit(100.0), col(whole))


def percent_text(value: Column | str) -> Column:
    """A percentage as written in the summary table, e.g. `12.34%`."""
    return F.when(col(value).isNotNull(), F.format_string("%.2f%%", col(value)))


def whole_number(c: Column | str) -> Column:
    """A count written as text, possibly padded with blanks."""
    return F.trim(col(c)).cast("long")


def duration_seconds(label: Column | str) -> Column:
    """`20s`, `2.5min`, `1h` -> seconds; null when the label is not a duration."""
    number = F.regexp_extract(col(label), r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(s|sec|m|min|h)\s*$", 1)
    unit = F.regexp_extract(col(label), r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(s|sec|m|min|h)\s*$", 2)
    scale = F.when(unit.isin("s", "sec"), 1.0).when(unit.isin("m", "min"), 60.0).when(unit == "h", 3600.0)
    return F.when(number != "", number.cast("double")) * scale
