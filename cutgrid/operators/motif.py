"""Cut sites from sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cutgrid.functions.sizing import stage
from cutgrid.operators.numbering import number_rows

# Chunks are cut down in two steps: finding letter i of a text takes i steps, so cutting a long
# text straight into short pieces would take quadratic time.
PIECES = (1 << 15, 1 << 10)


def _cut(chunks: DataFrame, width: int, overlap: int) -> DataFrame:
    starts = F.sequence(F.lit(0).cast("long"), F.col("span") - 1, F.lit(width).cast("long"))
    return chunks.withColumn("at", F.explode(starts)).select(
        "chrom", (F.col("offset") + F.col("at")).alias("offset"),
        F.least(F.col("span") - F.col("at"), F.lit(width)).alias("span"),
        F.substring("seq", F.col("at") + 1, F.lit(width + overlap)).alias("seq"),
    )


def find_motif(chunks: DataFrame, motif: str, ignore_case: bool = True) -> DataFrame:
    """Every occurrence of `motif`, overlapping ones too: `chrom, start, end` (0-based, half-open).

    `chunks` has `chrom, offset, span, seq`: the chunk owns `span` letters from `offset` on, and
    `seq` runs at least `len(motif) - 1` letters further where the contig does (`read_fasta` notes its overlap, which
    is checked). Short pieces are
    split in front of each hit; the running length of the parts gives the positions. No shuffle.
    """
    k = len(motif)
    overlap = chunks.schema["seq"].metadata.get("overlap")
    if overlap is not None and overlap < k - 1:
        raise ValueError(f"chunks overlap by {overlap} letters; a motif of {k} needs {k - 1}")
    mode = "(?i)" if ignore_case else ""
    quoted = f"\\Q{motif}\\E"
    pieces = chunks.filter("span > 0").select("chrom", "offset", F.col("span").cast("long").alias("span"), "seq")
    for width in PIECES:
        pieces = _cut(pieces, width, k - 1)
    pieces = pieces.filter(F.col("seq").rlike(mode + quoted))

    ends = F.aggregate(
        F.split("seq", f"{mode}(?={quoted})"), F.array(F.lit(0)),
        lambda acc, part: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(part))),
    )
    cuts = F.slice(ends, 2, F.size(ends) - 2)
    starts = F.when(F.col("seq").rlike(f"{mode}^{quoted}"), F.concat(F.array(F.lit(0)), cuts)).otherwise(cuts)
    return (
        pieces.select("chrom", "offset", "span", F.explode(starts).alias("local"))
        .filter("local < span")
        .select("chrom", (F.col("offset") + F.col("local")).alias("start"))
        .withColumn("end", F.col("start") + k)
    )


def name_sites(sites: DataFrame, prefix: str = "site_") -> DataFrame:
    """Number sites across the whole genome in (chromosome, position) order."""
    numbered = number_rows(stage(sites), "_row")
    return numbered.withColumn("name", F.concat(F.lit(prefix), F.col("_row").cast("string"))).drop("_row")
