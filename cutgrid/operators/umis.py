"""From positioned reads to UMI counts per cut site.

Reads are one long table: `libid, chrom, pos, strand, umi` (plus `qual` and an input-order key `ord`
where lists are exported). `by` names the library columns; every step handles all libraries at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import small, stage
from cutgrid.functions.text import percent
from cutgrid.operators.intervals import SiteIndex, index_sites, nearest
from cutgrid.operators.lists import LIST_ROWS, ordered_lists
from cutgrid.operators.numbering import number_rows
from cutgrid.params import MAX_SITE_DISTANCE

LIB = ("libid",)


def read_order(ord_key: str = "ord") -> list[Column]:
    """Order of reads on a site: by position, plus strand first ('+' sorts before '-'), then input."""
    return [F.col("pos"), F.col("strand"), F.col(ord_key)]


def shift_plus(reads: DataFrame, cs_len: int) -> DataFrame:
    """Move plus-strand reads back by the length of the cut sequence."""
    return reads.withColumn("pos", F.col("pos") - F.when(F.col("strand") == "+", cs_len).otherwise(0))


def group_positions(reads: DataFrame, by: Sequence[str] = LIB, max_rows: int = LIST_ROWS) -> DataFrame:
    """UMIs and qualities of every position, plus strand first, each in input order."""
    return ordered_lists(
        reads, [*by, "chrom", "pos"], ["umi", "qual"], [F.col("strand"), F.col("ord")], max_rows
    )


def known_chroms(reads: DataFrame, sites: DataFrame) -> DataFrame:
    """Reads on chromosomes that have sites."""
    return reads.join(small(sites.select("chrom").distinct()), "chrom", "left_semi")


def skipped_chroms(reads: DataFrame, sites: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Chromosomes without sites, and how many reads each library loses on them."""
    counts = reads.groupBy(*by, "chrom").agg(F.count("*").alias("n_umis"))
    return counts.join(sites.select("chrom").distinct(), "chrom", "left_anti")


def assign(
    reads: DataFrame, sites: DataFrame | SiteIndex, min_dist: int = MAX_SITE_DISTANCE
) -> DataFrame:
    """Nearest site of every read, and whether it lies too far away (`is_orphan`)."""
    index = sites if isinstance(sites, SiteIndex) else index_sites(sites)
    return nearest(reads, index).withColumn("is_orphan", F.col("dist") > min_dist)


def orphans(assigned: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Orphan reads, one row each: `pos` is the nearest site, not the read's position."""
    return assigned.filter("is_orphan").select(*by, "chrom", F.col("site").alias("pos"), "umi", "qual")


def orphan_groups(assigned: DataFrame, by: Sequence[str] = LIB, max_rows: int = LIST_ROWS) -> DataFrame:
    """Orphans as exported: one row per read position, not merged, with the nearest site as `pos`."""
    far = assigned.filter("is_orphan").withColumnRenamed("pos", "read_pos")
    lists = ordered_lists(
        far, [*by, "chrom", "site", "read_pos"], ["umi", "qual"], [F.col("strand"), F.col("ord")], max_rows
    )
    return lists.withColumnRenamed("site", "pos")


def merge_sites(assigned: DataFrame, by: Sequence[str] = LIB, max_rows: int = LIST_ROWS) -> DataFrame:
    """One row per site with the UMIs and qualities of its kept reads, in read order."""
    kept = assigned.filter(~F.col("is_orphan"))
    return ordered_lists(kept, [*by, "chrom", "site"], ["umi", "qual"], read_order(), max_rows)


def collapse_reads(reads: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """One row per distinct (position, UMI) with its number of reads `n`."""
    return reads.groupBy(*by, "chrom", "pos", "umi").agg(F.count("*").alias("n"))


def place_reads(
    reads: DataFrame, sites: DataFrame | SiteIndex, min_dist: int = MAX_SITE_DISTANCE, by: Sequence[str] = LIB
) -> DataFrame:
    """Reads on their sites with a weight `n`: input order and qualities are given up.

    When the site look-up is too large to be broadcast, reads are collapsed before they are shuffled
    to it, so copies of a read travel once.
    """
    index = sites if isinstance(sites, SiteIndex) else index_sites(sites)
    if index.fits_broadcast:
        weighted = reads.select(*by, "chrom", "pos", "umi").withColumn("n", F.lit(1).cast("long"))
    else:
        weighted = collapse_reads(reads, by)
    return assign(weighted, index, min_dist)


def counts_per_site(placed: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Reads (`pre_n`) and distinct UMIs (`counts`) per site, out of placed reads.

    Both levels combine before they shuffle, so a site that holds a large part of all reads costs no
    more than its distinct UMIs.
    """
    return (
        placed.filter(~F.col("is_orphan"))
        .groupBy(*by, "chrom", "site", "umi").agg(F.sum("n").alias("n"))
        .groupBy(*by, "chrom", "site").agg(F.sum("n").alias("pre_n"), F.count("*").alias("counts"))
    )


def site_counts(
    reads: DataFrame, sites: DataFrame | SiteIndex, min_dist: int = MAX_SITE_DISTANCE, by: Sequence[str] = LIB
) -> DataFrame:
    """Reads and distinct UMIs per site: placing, distance filter and strict deduplication."""
    return counts_per_site(place_reads(reads, sites, min_dist, by), by)


def unique_umis(assigned: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Distinct UMIs of every site with their number of reads and the first place they were seen."""
    first = F.min(F.struct("pos", "strand", "ord")).alias("first_seen")
    return (
        assigned.filter(~F.col("is_orphan"))
        .groupBy(*by, "chrom", "site", "umi").agg(F.count("*").alias("n"), first)
    )


def dedup_lists(assigned: DataFrame, by: Sequence[str] = LIB, max_rows: int = LIST_ROWS) -> DataFrame:
    """Unique UMIs of every site as a list in first-seen order, with their number `counts`."""
    lists = ordered_lists(
        unique_umis(assigned, by), [*by, "chrom", "site"], ["umi"], [F.col("first_seen")], max_rows
    )
    return lists.withColumnRenamed("umi", "umis").withColumnRenamed("n", "counts")


def dedup_totals(counts: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Reads before deduplication, removed, kept, and the removed share."""
    totals = counts.groupBy(*by).agg(F.sum("pre_n").alias("reads"), F.sum("counts").alias("kept"))
    return totals.withColumn("removed", F.col("reads") - F.col("kept")).withColumn(
        "removed_pct", percent("removed", "reads")
    )


def umi_lengths(reads: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Distinct UMI lengths and, as used when there are several, their mean."""
    lengths = reads.groupBy(*by, F.length("umi").alias("len")).agg(F.lit(1).alias("one"))
    return lengths.groupBy(*by).agg(
        F.sort_array(F.collect_list("len")).alias("lengths"),
        F.count("*").alias("n_lengths"), F.avg("len").alias("mean_length"),
    )


def assign_stats(assigned: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Totals of the site assignment: reads and positions before, after the distance filter, merged.

    Distances are summarised over distinct positions, not over reads.
    """
    reads = F.sum("n") if "n" in assigned.columns else F.count("*")
    return _totals(assigned.groupBy(*by, "chrom", "pos", "site", "dist", "is_orphan").agg(reads.alias("n")), by)


def position_stats(
    reads: DataFrame, sites: DataFrame | SiteIndex, min_dist: int = MAX_SITE_DISTANCE, by: Sequence[str] = LIB
) -> DataFrame:
    """The same from reads that have no sites yet: they are counted by position first, and only positions are looked up."""
    counted = reads.groupBy(*by, "chrom", "pos").agg(F.count("*").alias("n"))
    return _totals(assign(counted, sites, min_dist), by)


def _totals(positions: DataFrame, by: Sequence[str]) -> DataFrame:
    """`positions`: one row per library and position, with `n` reads."""
    per_site = positions.groupBy(*by, "chrom", "site").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_pos"),
        F.coalesce(F.sum(F.when(~F.col("is_orphan"), F.col("n"))), F.lit(0)).alias("clean"),
        F.count_if(~F.col("is_orphan")).alias("clean_pos"),
        F.min("dist").alias("d_min"), F.sum("dist").alias("d_sum"), F.max("dist").alias("d_max"),
    )
    totals = per_site.groupBy(*by).agg(
        F.sum("n").alias("n_umis"), F.sum("n_pos").alias("n_pos"),
        F.min("d_min").alias("dist_min"),
        (F.sum("d_sum") / F.sum("n_pos")).alias("dist_mean"),
        F.max("d_max").alias("dist_max"),
        F.sum("clean").alias("n_clean_umis"), F.sum("clean_pos").alias("n_clean_pos"),
        F.count_if(F.col("clean_pos") > 0).alias("n_sites"),
    )
    return (
        totals.withColumn("clean_umis_pct", percent("n_clean_umis", "n_umis"))
        .withColumn("clean_pos_pct", percent("n_clean_pos", "n_pos"))
        .withColumn("sites_pct", percent("n_sites", "n_pos"))
    )


def site_bed(counts: DataFrame, by: Sequence[str] = LIB) -> DataFrame:
    """Site counts as BED rows `pos_1, pos_2, ...`, numbered per library over the sorted file."""
    rows = stage(counts.select(*by, "chrom", F.col("site").alias("start"), F.col("counts").alias("score")))
    return number_rows(rows, "_row", by).select(
        *by, "chrom", "start", F.col("start").alias("end"),
        F.concat(F.lit("pos_"), F.col("_row").cast("string")).alias("name"), "score",
    )
