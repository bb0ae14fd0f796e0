"""One function per step that users run on files: paths in, folders of text files out.

Inputs may hold many libraries; outputs have one folder `libid=...` per library. An output that
exists already is an error. Steps that run one after the other are better chained as tables (see
`preprocess`), because text lists between them cost a round of sorting and parsing each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cutgrid.functions.sizing import stage
from cutgrid.operators import umis as um
from cutgrid.operators.logs import log_metrics, require_metrics
from cutgrid.operators.summary import summary_from_logs
from cutgrid.params import MAX_SITE_DISTANCE, ScoreParams
from cutgrid.plans.score import score
from cutgrid.sources import sinks, tables as tb


def group_umis(
    spark: SparkSession, plus: tb.Paths, reverse: tb.Paths, out: str, cs_len: int = 0, sep: str = "\t",
    compress: bool = True,
) -> None:
    """Shift plus-strand reads by the cut-site length and group the UMIs of both strands by position."""
    long = tb.read_stranded_umis(spark, plus, reverse, sep)
    sinks.write_grouped(um.group_positions(um.shift_plus(long, cs_len)), out, compress=compress, sep=sep)


def umis_to_sites(
    spark: SparkSession, umis: tb.Paths, cutsites: tb.Paths, folder: str, name: str,
    min_dist: int = MAX_SITE_DISTANCE, sep: str = "\t", compress: bool = True,
) -> DataFrame:
    """Assign grouped UMIs to their nearest cut sites; merged sites and orphans out.

    Returns the totals and distance summary per library.
    """
    placed = stage(um.assign(tb.read_grouped_umis(spark, umis, sep), tb.read_bed(spark, cutsites), min_dist))
    sinks.write_assigned(um.merge_sites(placed), um.orphan_groups(placed), folder, name, compress=compress)
    return um.assign_stats(placed)


def deduplicate(spark: SparkSession, umis: tb.Paths, out: str, compress: bool = True) -> DataFrame:
    """Unique UMIs per site out of merged sites; returns the totals per library."""
    reads = stage(tb.read_grouped_umis(spark, umis).withColumnsRenamed({"pos": "site"}).withColumns(
        {"is_orphan": F.lit(False), "pos": F.lit(0).cast("long"), "n": F.lit(1).cast("long")}
    ))
    sinks.write_dedup(um.dedup_lists(reads), out, compress=compress)
    return um.dedup_totals(um.counts_per_site(reads))


def final_bed(spark: SparkSession, dedup: tb.Paths, out: str, compress: bool = True) -> None:
    """Numbered five-column BED out of deduplicated sites."""
    counts = tb.read_dedup_umis(spark, dedup).groupBy("libid", "chrom", F.col("pos").alias("site")).agg(
        F.sum("counts").alias("counts")
    )
    sinks.write_site_bed(um.site_bed(counts), out, compress=compress)


def summary_of_logs(spark: SparkSession, root: str, sep: str = "_") -> DataFrame:
    """Summary of an earlier run from its stage logs, one row per library with a FASTQ file.

    Reading the table fails when a library lacks a log line.
    """
    root = root.rstrip("/")
    libraries = tb.library_files(spark, f"{root}/fastq/*", sep).select("libid").distinct()
    found = libraries.join(log_metrics(tb.read_logs(spark, root)), "libid", "left")
    return summary_from_logs(require_metrics(found), root.rsplit("/", 1)[-1])


def score_files(
    spark: SparkSession, metadata: str, out: str, sizes: tb.Paths, params: ScoreParams = ScoreParams(),
    site_bed: tb.Paths | None = None, mask_bed: tb.Paths | None = None, bin_bed: tb.Paths | None = None,
    sites: DataFrame | None = None,
) -> DataFrame:
    """Scores of the experiments in a condition table, written per experiment and bin tag; sites as a BED or as a table."""
    conditions = tb.read_conditions(spark, metadata)
    counts = tb.read_condition_counts(spark, conditions)
    regions = None
    if bin_bed is not None:
        regions = tb.read_bed(spark, bin_bed, 3).withColumnsRenamed({"start": "region_start", "end": "region_end"})
    table = score(
        counts, conditions, tb.read_bed(spark, sizes, 3), params,
        sites=sites if site_bed is None else tb.read_bed(spark, site_bed),
        mask=None if mask_bed is None else tb.read_bed(spark, mask_bed), regions=regions,
    )
    sinks.write_scores(table, out)
    return table

