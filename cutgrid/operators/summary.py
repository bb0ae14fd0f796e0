"""The per-library summary table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cutgrid.functions.text import percent, percent_text
from cutgrid.schemas import SUMMARY_COLUMNS

RATIOS = {
    "umi_hq%": ("umi_hq", "input"), "prefix%": ("prefix", "umi_hq"), "mapped%": ("mapped", "prefix"),
    "fromCS%": ("fromCS", "n_umis"), "uniq%": ("uniq", "fromCS"), "out%": ("uniq", "input"),
}


def read_counts(status: DataFrame) -> DataFrame:
    """Reads per library in the flag stage; `status` has `status` and, for passing reads, `prefix_ok`."""
    passed = F.col("status") == "hq"
    return status.groupBy("libid").agg(
        F.count("*").alias("input"), F.count_if(passed).alias("umi_hq"),
        F.count_if(passed & F.col("prefix_ok")).alias("prefix"),
    )


def site_totals(stats: DataFrame, counts: DataFrame) -> DataFrame:
    """Assigned reads, reads close to a site and distinct UMIs per library."""
    uniq = counts.groupBy("libid").agg(F.sum("counts").alias("uniq"))
    return stats.select("libid", "n_umis", F.col("n_clean_umis").alias("fromCS")).join(uniq, "libid", "left")


def summarize(stages: list[DataFrame], prep_run: str, libraries: DataFrame | None = None) -> DataFrame:
    """Join the per-library counts of all stages and add the ratios (as numbers, in percent).

    Every stage table has one row per library, so these joins are tiny. A library without rows in a
    stage gets nulls there.
    """
    tables = ([libraries.select("libid").distinct()] if libraries is not None else []) + stages
    joined = reduce(lambda a, b: a.join(b, "libid", "left" if libraries is not None else "full"), tables)
    if "2nd_aln" not in joined.columns:
        joined = joined.withColumn("2nd_aln", F.lit(None).cast("long"))
    ratios = {name: percent(f"`{part}`", f"`{whole}`") for name, (part, whole) in RATIOS.items()}
    return joined.withColumns(ratios).withColumnRenamed("libid", "library_id").withColumn(
        "prep_run", F.lit(prep_run)
    ).select(*[F.col(f"`{c}`") for c in SUMMARY_COLUMNS])


def summary_from_logs(metrics: DataFrame, prep_run: str) -> DataFrame:
    """The summary of an earlier run: shares as its logs state them, the other ratios from counts."""
    computed = {name: percent_text(percent(f"`{part}`", f"`{whole}`")) for name, (part, whole) in RATIOS.items()
                if name in ("mapped%", "uniq%", "out%")}
    return metrics.withColumns(computed).withColumnRenamed("libid", "library_id").withColumn(
        "prep_run", F.lit(prep_run)
    ).select(*[F.col(f"`{c}`") for c in SUMMARY_COLUMNS])


def as_text(summary: DataFrame) -> DataFrame:
    """Ratios as text with two decimals and a percent sign, rows sorted by library."""
    kinds = dict(summary.dtypes)
    return summary.select(*[
        percent_text(f"`{c}`").alias(c) if c.endswith("%") and kinds[c] == "double" else F.col(f"`{c}`")
        for c in summary.columns
    ]).orderBy("library_id")
