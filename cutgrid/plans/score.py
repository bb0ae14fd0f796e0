"""From site counts of ordered conditions to scores at several resolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cutgrid.functions.sizing import sized, stage
from cutgrid.operators import bins as bn, scores as sc
from cutgrid.operators.intervals import intervals_outside_mask
from cutgrid.params import ScoreParams, parse_chrom_tag

CUSTOM = "custom"


def bin_table(
    sizes: DataFrame, params: ScoreParams, mask: DataFrame | None = None, regions: DataFrame | None = None
) -> DataFrame:
    """The bins of a run: all tags, or custom regions instead, without masked ones; whole chromosomes if wanted."""
    if regions is None:
        tables = bn.make_bins(sizes, params.tags, params.elongate_ter_bin)
    else:
        tables = regions.filter("region_end > region_start").select(
            F.lit(CUSTOM).alias("bin_tag"), "chrom", F.col("region_start").alias("start"), F.col("region_end").alias("end")
        ).distinct()
    if mask is not None:
        tables = intervals_outside_mask(tables, mask)
    if params.chromosome_wide:
        tables = tables.unionByName(bn.chromosome_bins(sizes))
    return tables.select("bin_tag", "chrom", "start", "end")


def _in_bins(points: DataFrame, bins: DataFrame, params: ScoreParams, custom: bool, by: list[str]) -> DataFrame:
    """Reads and sites per bin of the table, for points with a `score`."""
    if not custom:
        return bn.count_in_bins(points, params.tags, by, params.chromosome_wide).join(bins, bn.BIN)
    wanted = bins.filter(F.col("bin_tag") == CUSTOM).select(
        "chrom", F.col("start").alias("region_start"), F.col("end").alias("region_end")
    )
    columns = [*by, *bn.SPAN, "reads", "sites"]
    binned = bn.count_in_regions(points, wanted, by).withColumnsRenamed(
        {"region_start": "start", "region_end": "end"}
    ).withColumn("bin_tag", F.lit(CUSTOM)).select(*columns)
    if params.chromosome_wide:
        whole = bn.count_in_bins(points, [], by, True).join(bins, bn.BIN).select(*columns)
        binned = binned.unionByName(whole)
    return binned


def rates(
    counts: DataFrame, conditions: DataFrame, bins: DataFrame, params: ScoreParams, sites: DataFrame | None = None,
    custom: bool = False,
) -> DataFrame:
    """Rate per condition and bin of the table (`custom`: it holds custom regions instead of sliding bins)."""
    binned = _in_bins(counts, bins, params, custom, ["libid"])
    if params.site_domain == "universe":
        if sites is None:
            raise ValueError("site_domain 'universe' needs the sites")
        points = sites.select("chrom", "start").distinct().withColumn("score", F.lit(0).cast("long"))
        domain = _in_bins(points, bins, params, custom, []).drop("reads")
        binned = sc.universe_bins(binned, domain, conditions, bn.SPAN)
    keys = ["libid"] if params.normalize_by == "lib" else ["libid", "chrom"]
    return bn.with_conditions(sc.bin_rates(binned, bn.library_totals(counts, keys), params.normalize_by), conditions)


def score(
    counts: DataFrame, conditions: DataFrame, sizes: DataFrame, params: ScoreParams = ScoreParams(),
    sites: DataFrame | None = None, mask: DataFrame | None = None, regions: DataFrame | None = None,
) -> DataFrame:
    """Rescaled scores of all experiments and bin tags.

    `counts` is `libid, chrom, start, score`, one row per library and site. A library may serve several experiments: its
    counts come once, and conditions are attached to them here. Depth outliers and chromosomes that are not asked for
    go first; the cleaned counts, the bins and the scores are staged because several steps read them.
    """
    names = parse_chrom_tag(params.chrom_tag)
    kept = stage(sc.bed_outliers(bn.keep_chroms(counts, names), params.bed_outlier_tag).filter("not is_outlier").drop("is_outlier"))
    bins = sized(bn.keep_chroms(bin_table(sizes, params, mask, regions), names))
    rated = rates(kept, conditions, bins, params, sites, regions is not None)
    scored = stage(sc.bin_scores(rated, conditions, params.site_domain))
    return sc.rescale_scores(scored, params.score_outlier_tag, params.normalize_by)
