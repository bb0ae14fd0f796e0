"""Alignment filters, counts and the position a read votes for. One narrow pass plus one aggregate.

Alignments are `libid, read_id, flag, chrom, pos (1-based), mapq, cigar, rnext`, with the UMI either
in columns or in the read name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.text import has_bits, reference_length
from cutgrid.params import MIN_MAPQ

# Bits of the alignment flag and the default mitochondrial name.
PAIRED, UNMAPPED, MATE_UNMAPPED, REVERSE, SECONDARY = 1, 4, 8, 16, 256
MITOCHONDRIAL = ("chrM",)


def is_chimeric() -> Column:
    """Paired read whose mate lies on another chromosome."""
    mate_elsewhere = ~F.col("rnext").isin("=", "*") & (F.col("rnext") != F.col("chrom"))
    return has_bits("flag", PAIRED) & ~has_bits("flag", UNMAPPED | MATE_UNMAPPED) & mate_elsewhere


def is_clean(min_mapq: int = MIN_MAPQ, mito_names: Sequence[str] = MITOCHONDRIAL) -> Column:
    return (
        (F.col("mapq") >= min_mapq) & ~has_bits("flag", SECONDARY | UNMAPPED) & ~is_chimeric()
        & ~F.col("chrom").isin(*mito_names)
    )


def filter_alignments(
    alignments: DataFrame, min_mapq: int = MIN_MAPQ, mito_names: Sequence[str] = MITOCHONDRIAL
) -> DataFrame:
    return alignments.filter(is_clean(min_mapq, mito_names))


def alignment_counts(
    alignments: DataFrame, min_mapq: int = MIN_MAPQ, mito_names: Sequence[str] = MITOCHONDRIAL
) -> DataFrame:
    """Counts per library in one pass; they are independent of each other and may overlap."""
    counts = [
        F.count_if(has_bits("flag", UNMAPPED)).alias("unmapped"),
        F.count_if(F.col("mapq") < min_mapq).alias("low_mapq"),
        F.count_if(F.col("chrom").isin(*mito_names)).alias("chrM"),
        F.count_if(is_clean(min_mapq, mito_names)).alias("mapped"),
    ]
    if "multi" in alignments.columns:
        counts.append(F.count_if("multi").alias("2nd_aln"))
    return alignments.groupBy("libid").agg(*counts)


def umi_from_name(alignments: DataFrame, name: str = "read_id", flag: str = "umi") -> DataFrame:
    """Take `umi` and `umi_qual` out of a read name that carries flags: the pieces behind `~~umi~` and `~~qumi~`.

    The names of the flags say where their pieces are, so any prefix pattern will do. Qualities may hold `~` themselves:
    a piece ends where the next name begins. A name without the flag gives null.
    """
    def behind(label: str) -> Column:
        return F.nullif(F.regexp_extract(name, f"~~{label}~(.*?)(?=~~q?[A-Za-z_]+~|$)", 1), F.lit(""))

    return alignments.withColumns({flag: behind(flag), f"{flag}_qual": behind(f"q{flag}")})


def to_intervals(alignments: DataFrame) -> DataFrame:
    """Add `strand` and the 0-based half-open `start`, `end` on the reference."""
    start = F.col("pos") - 1
    return alignments.withColumns({
        "strand": F.when(has_bits("flag", REVERSE), "-").otherwise("+"),
        "start": start, "end": start + reference_length("cigar"),
    })


def positioned_umis(clean: DataFrame) -> DataFrame:
    """Long UMI table: reverse reads sit at their end, plus reads at their start.

    Without an `ord` column the read name orders reads on one position.
    """
    cut = to_intervals(clean)
    order = F.col("ord") if "ord" in clean.columns else F.col("read_id")
    return cut.select(
        "libid", "chrom", F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start")).alias("pos"),
        "strand", "umi", F.col("umi_qual").alias("qual"), order.alias("ord"),
    )
