"""Prefix flags of sequencer reads: extraction, quality and barcode filters, frequencies.

Reads are `libid, read_id, seq, qual` (other columns pass through). Everything up to the
frequencies is one narrow pass over the reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import small
from cutgrid.functions.text import low_quality_bases, substitutions
from cutgrid.params import MAX_LOW_SHARE, MAX_SUBSTITUTIONS, MIN_PHRED, Flag, parse_pattern

# Names of the reject groups.
PASSED, UNMATCHED, LOW_QUALITY = "hq", "unmatched", "lq"


def prefix_length(flags: Sequence[Flag]) -> int:
    return sum(flag.width for flag in flags)


def extract_flags(reads: DataFrame, pattern: str) -> DataFrame:
    """Cut the prefix off: `<flag>` and `<flag>_qual` columns, shorter `seq` and `qual`.

    `matched` is false for reads shorter than the prefix; these keep their text and get null flags.
    """
    flags = parse_pattern(pattern)
    total = prefix_length(flags)
    matched = F.length("seq") >= total

    def piece(text: str, flag: Flag) -> Column:
        return F.when(matched, F.substring(text, flag.start, flag.width))

    def rest(text: str) -> Column:
        return F.when(matched, F.substring(F.col(text), F.lit(total + 1), F.length(text))).otherwise(F.col(text))

    columns = {f.name: piece("seq", f) for f in flags} | {f"{f.name}_qual": piece("qual", f) for f in flags}
    return reads.withColumns(columns | {"matched": matched, "seq": rest("seq"), "qual": rest("qual")})


def quality_passes(
    qual: str, min_phred: int = MIN_PHRED, max_low_share: float = MAX_LOW_SHARE
) -> Column:
    """Whether at most `max_low_share` of the bases lie below `min_phred`."""
    return low_quality_bases(qual, min_phred) <= F.length(qual) * F.lit(max_low_share)


def flag_status(
    flagged: DataFrame, flag: str = "umi", min_phred: int = MIN_PHRED, max_low_share: float = MAX_LOW_SHARE
) -> DataFrame:
    """Add `status`: hq, lq (flag quality too low) or unmatched (shorter than the prefix)."""
    passes = quality_passes(f"{flag}_qual", min_phred, max_low_share)
    return flagged.withColumn(
        "status", F.when(~F.col("matched"), UNMATCHED).when(passes, PASSED).otherwise(LOW_QUALITY)
    )


def flag_matches(flag: Column | str, expected: Column | str, width: int, max_subs: int = MAX_SUBSTITUTIONS) -> Column:
    """Whether a flag equals the expected text but for at most `max_subs` substitutions (no shifts)."""
    return F.coalesce(substitutions(flag, expected, width) <= max_subs, F.lit(False))


def with_barcodes(reads: DataFrame, config: DataFrame) -> DataFrame:
    """Add the expected `barcode` of the read's library."""
    return reads.join(small(config.select("libid", "barcode")), "libid")


def prefix_status(
    flagged: DataFrame, config: DataFrame, cut_seq: str, pattern: str, max_subs: int = MAX_SUBSTITUTIONS
) -> DataFrame:
    """Add `prefix_ok`: barcode as configured for the library and cut site as given."""
    width = {flag.name: flag.width for flag in parse_pattern(pattern)}
    ok = flag_matches("bc", "barcode", width["bc"], max_subs) & flag_matches(
        "cs", F.lit(cut_seq), width["cs"], max_subs
    )
    return with_barcodes(flagged, config).withColumn("prefix_ok", ok)


def flagged_name(pattern: str, read_id: str = "read_id") -> Column:
    """Read name that carries all flags and then all their qualities, joined by `~`.

    An aligner copies the name, so the UMI comes back with the alignment.
    """
    names = [flag.name for flag in parse_pattern(pattern)]
    pieces = [F.concat(F.lit(f"~~{n}~"), F.col(n)) for n in names]
    pieces += [F.concat(F.lit(f"~~q{n}~"), F.col(f"{n}_qual")) for n in names]
    return F.concat(F.col(read_id), *pieces)


def flag_stats(flagged: DataFrame, flags: Sequence[str] = ("bc", "cs")) -> DataFrame:
    """How often every value of the given flags occurs per library, and its share."""
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("value")) for f in flags]))
    counts = (
        flagged.filter("matched").select("libid", values.alias("_f")).groupBy("libid", "_f.flag", "_f.value")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("libid", "flag").agg(F.sum("n").alias("total"))
    # Both sides start from the same exchange of counts, so the reads are scanned once.
    return counts.join(totals, ["libid", "flag"]).withColumn("share", F.col("n") / F.col("total")).drop("total")


def flag_top(stats: DataFrame, expected: DataFrame) -> DataFrame:
    """Most frequent value per library and flag, and whether it is the `expected` one.

    `expected` has `libid, flag, expected`. Of equally frequent values the first in text order wins.
    """
    top = stats.groupBy("libid", "flag").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), "value", "n")).alias("_top")
    )
    return (
        top.select("libid", "flag", F.col("_top.value").alias("value"), F.col("_top.n").alias("n"))
        .join(small(expected), ["libid", "flag"], "left")
        .withColumn("is_expected", F.coalesce(F.col("value") == F.col("expected"), F.lit(False)))
    )


def expected_flags(config: DataFrame, cut_seq: str) -> DataFrame:
    """The flag values a run expects, in the form `flag_top` wants."""
    pair = F.explode(F.array(
        F.struct(F.lit("bc").alias("flag"), F.col("barcode").alias("expected")),
        F.struct(F.lit("cs").alias("flag"), F.lit(cut_seq).alias("expected")),
    ))
    return config.select("libid", pair.alias("_e")).select("libid", "_e.flag", "_e.expected")
