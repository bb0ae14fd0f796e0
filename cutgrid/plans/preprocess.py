"""From reads and alignments to site counts and the summary, for all libraries of a run at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cutgrid.functions.sizing import stage
from cutgrid.operators import alignments as aln, reads as rd, summary as sm, umis as um
from cutgrid.operators.intervals import index_sites
from cutgrid.operators.motif import find_motif, name_sites
from cutgrid.params import LibraryParams
from cutgrid.sources.fasta import read_fasta
from cutgrid.sources.fastq import read_fastq
from cutgrid.sources.sam import read_sam
from cutgrid.sources.sinks import write_reads, write_site_bed, write_summary
from cutgrid.sources.tables import read_bed, read_config


def cut_sites(spark: SparkSession, genome: str, params: LibraryParams = LibraryParams(), prefix: str = "chr") -> DataFrame:
    """Named cut sites of a genome; write them as Parquet once per genome and enzyme."""
    chunks = read_fasta(spark, genome, prefix, overlap=len(params.cut_seq) - 1)
    return name_sites(find_motif(chunks, params.cut_seq))


def flag_reads(reads: DataFrame, config: DataFrame, params: LibraryParams = LibraryParams()) -> DataFrame:
    """All reads with their flags, `status` and `prefix_ok`: one narrow pass."""
    flagged = rd.flag_status(
        rd.extract_flags(reads, params.pattern), "umi", params.min_phred, params.max_low_share
    )
    return rd.prefix_status(flagged, config, params.cut_seq, params.pattern, params.max_subs)


def reads_to_align(flagged: DataFrame) -> DataFrame:
    return flagged.filter((F.col("status") == rd.PASSED) & F.col("prefix_ok"))


@dataclass(frozen=True)
class Counted:
    """Tables of a preprocessed run."""

    counts: DataFrame
    bed: DataFrame
    stats: DataFrame
    alignment_counts: DataFrame


def count_sites(alignments: DataFrame, sites: DataFrame, params: LibraryParams = LibraryParams()) -> Counted:
    """Alignments to deduplicated counts per cut site.

    Placed reads and site counts are staged, because the BED, the totals and the summary start from
    them and alignments should not be scanned again for each.
    """
    clean = aln.filter_alignments(alignments, params.min_mapq, params.mito_names)
    umis = um.shift_plus(aln.positioned_umis(clean), params.cs_len)
    placed = stage(um.place_reads(umis, index_sites(sites), params.min_dist))
    counts = stage(um.counts_per_site(placed))
    return Counted(
        counts=counts,
        bed=um.site_bed(counts),
        stats=um.assign_stats(placed),
        alignment_counts=aln.alignment_counts(alignments, params.min_mapq, params.mito_names),
    )


def preprocess(
    reads: DataFrame, alignments: DataFrame, config: DataFrame, sites: DataFrame, prep_run: str,
    params: LibraryParams = LibraryParams(),
) -> tuple[Counted, DataFrame]:
    """Site counts of all libraries and their summary table."""
    counted = count_sites(alignments, sites, params)
    stages = [
        sm.read_counts(flag_reads(reads, config, params)), counted.alignment_counts,
        sm.site_totals(counted.stats, counted.counts),
    ]
    return counted, sm.summarize(stages, prep_run, config)


def write_prepared(flagged: DataFrame, out: str, params: LibraryParams = LibraryParams(), **options) -> None:
    """Reads to align (flags in the names) and rejects, out of staged reads that `flag_reads` has judged; `options` as for `write_reads`."""
    group = F.when(F.col("status") != rd.PASSED, F.col("status")).when(F.col("prefix_ok"), "prefix").otherwise(
        "prefix_unmatched"
    )
    passed = flagged.withColumn("status", group)
    write_reads(passed.filter("status = 'prefix'").drop("status"), f"{out}/fastq_prefix", params.pattern, **options)
    write_reads(passed.filter("status != 'prefix'"), f"{out}/fastq_rejected", **options)


def prepare_run(
    spark: SparkSession, config: str, fastq: str, out: str, params: LibraryParams = LibraryParams()
) -> None:
    """First half of a run: FASTQ in; reads to align (flags in the names) and rejects out."""
    # Both outputs start from staged reads, so FASTQ is parsed and judged once.
    write_prepared(stage(flag_reads(read_fastq(spark, fastq), read_config(spark, config), params)), out, params)


def finish_run(
    spark: SparkSession, config: str, fastq: str, sam: str, sites: str, out: str, prep_run: str,
    params: LibraryParams = LibraryParams(),
) -> Counted:
    """Second half of a run: aligned reads in; BED files and the summary table out."""
    alignments = aln.umi_from_name(read_sam(spark, sam))
    counted, summary = preprocess(
        read_fastq(spark, fastq), alignments, read_config(spark, config), read_bed(spark, sites), prep_run, params
    )
    write_site_bed(counted.bed, f"{out}/bed")
    write_summary(summary, f"{out}/summary_table")
    return counted
