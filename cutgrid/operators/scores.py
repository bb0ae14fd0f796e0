"""Scores of bins over conditions that are ordered from weak to strong.

The definitions are this package's own: rate = reads / (sites * all reads of the condition), score =
sum over the stronger conditions of log2(rate / rate of the weakest).
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from cutgrid.functions.sizing import small
from cutgrid.functions.text import duration_seconds
from cutgrid.operators.bins import BIN, SPAN, for_each_library
from cutgrid.operators.numbering import ranked
from cutgrid.params import parse_outlier_tag

# Scores closer than this are equal: sums of logarithms of equal rates differ in their last bits.
TOLERANCE = 1e-9
EXP_BIN = ["exid", *SPAN]


def bed_outliers(counts: DataFrame, tag: str = "chisq:0.01") -> DataFrame:
    """Flag sites of unusual depth: squared z-score above the chi-square(1) quantile."""
    _, p = parse_outlier_tag(tag, ["chisq"])
    limit = NormalDist().inv_cdf(1 - p / 2) ** 2
    stats = small(counts.groupBy("libid").agg(F.avg("score").alias("_mean"), F.var_samp("score").alias("_var")))
    z2 = F.try_divide((F.col("score") - F.col("_mean")) ** 2, F.col("_var"))
    return (
        counts.join(stats, "libid").withColumn("is_outlier", F.coalesce(z2 > limit, F.lit(False)))
        .drop("_mean", "_var")
    )


def bin_rates(binned: DataFrame, totals: DataFrame, normalize_by: str = "lib") -> DataFrame:
    """Rate of every bin in every library: reads of the bin by its sites and all reads.

    `totals` comes from `library_totals`. A library without any read on a chromosome has rate 0 there.
    """
    keys = ["libid"] if normalize_by == "lib" else ["libid", "chrom"]
    rated = binned.join(small(totals.select(*keys, "total_reads")), keys, "left")
    rate = F.col("reads") / (F.col("sites") * F.col("total_reads"))
    return rated.withColumn("rate", F.coalesce(rate, F.lit(0.0)))


def universe_bins(binned: DataFrame, domain: DataFrame, libraries: DataFrame, key: Sequence[str] = BIN) -> DataFrame:
    """Bins over all sites of a domain, for every library; one without reads has 0.

    `domain` has the bins of the domain with their `sites`, `binned` the bins that have reads; both are keyed by `key`.
    """
    every = for_each_library(domain, libraries)
    return every.join(binned.select("libid", *key, "reads"), ["libid", *key], "left").withColumn(
        "reads", F.coalesce("reads", F.lit(0).cast("long"))
    )


def condition_counts_per_experiment(conditions: DataFrame) -> DataFrame:
    return conditions.groupBy("exid").agg(F.count("*").alias("n_conditions"))


def bin_scores(rates: DataFrame, conditions: DataFrame, site_domain: str = "separate") -> DataFrame:
    """Score per experiment and bin; null when a rate is 0.

    With `separate` site domains only bins seen in every condition are scored. In a `universe` every bin with
    sites has a row in every condition, and one without reads somewhere stays in the table without a score.

    One aggregate: log2 ratios add up to the sum of the stronger conditions' logs minus the weakest
    condition's log as many times. Rows per bin are as many as there are conditions.
    """
    weak = F.min_by("log_rate", "cond_order")
    complete = small(condition_counts_per_experiment(conditions))
    return (
        rates.withColumn("log_rate", F.when(F.col("rate") > 0, F.log2("rate")))
        .groupBy(*EXP_BIN)
        .agg(
            F.count("*").alias("n"), F.count("log_rate").alias("n_rates"),
            F.sum("log_rate").alias("sum_log"), weak.alias("weak_log"),
        )
        .join(complete, "exid").filter(F.col("n") == F.col("n_conditions") if site_domain == "separate" else F.lit(True))
        .select(*EXP_BIN, F.when(
            F.col("n_rates") == F.col("n_conditions"), F.col("sum_log") - F.col("n") * F.col("weak_log")
        ).alias("score"))
    )


def _group(normalize_by: str) -> list[str]:
    return ["exid", "bin_tag"] + (["chrom"] if normalize_by == "chr" else [])


def score_fences(scores: DataFrame, tag: str = "iqr:1.5", normalize_by: str = "lib") -> DataFrame:
    """Exact quartiles (linear between the two scores around them) and outlier fences per experiment and bin tag (and chromosome).

    The scores around a quartile are picked by their exact rank, so no task holds the scores of a group.
    """
    _, reach = parse_outlier_tag(tag, ["iqr"])
    keys = _group(normalize_by)
    rows = ranked(scores.filter("score is not null").select(*keys, "score"), keys, ["score"])

    def quartile(share: float) -> Column:
        place = (F.col("n") - 1) * F.lit(share)
        low, high = F.floor(place), F.ceil(place)
        at = lambda rank: F.max(F.when(F.col("rank") == rank, F.col("score")))
        part = F.max(place - low)
        return at(low) + (at(high) - at(low)) * part

    wanted = [f((F.col("n") - 1) * F.lit(share)) for share in (0.25, 0.75) for f in (F.floor, F.ceil)]
    iqr = F.col("q3") - F.col("q1")
    return (
        rows.filter(F.col("rank").isin(*wanted)).groupBy(*keys)
        .agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
        .withColumn("low", F.col("q1") - reach * iqr).withColumn("high", F.col("q3") + reach * iqr)
    )


def rescale_scores(scores: DataFrame, tag: str = "iqr:1.5", normalize_by: str = "lib") -> DataFrame:
    """Rescale scores to 0..1 over the bins inside the fences; outliers get a flag and no rescaled value.

    A bin without a score is no outlier and has no rescaled value. Where all scores of a group are equal there is nothing to rescale by, and the value is null.
    `scores` is read several times: stage it first when it is expensive.
    """
    keys = _group(normalize_by)
    flagged = scores.join(small(score_fences(scores, tag, normalize_by)), keys, "left").withColumn(
        "is_outlier", F.coalesce(
            (F.col("score") < F.col("low") - TOLERANCE) | (F.col("score") > F.col("high") + TOLERANCE), F.lit(False)
        ),
    )
    inside = F.when(~F.col("is_outlier"), F.col("score"))
    limits = small(flagged.groupBy(*keys).agg(F.min(inside).alias("_lo"), F.max(inside).alias("_hi")))
    spread = F.col("_hi") - F.col("_lo")
    rescaled = F.when(spread > TOLERANCE, (F.col("score") - F.col("_lo")) / spread)
    return flagged.join(limits, keys, "left").select(
        *EXP_BIN, "score", "is_outlier", F.when(~F.col("is_outlier"), rescaled).alias("rescaled")
    )


def condition_order(conditions: DataFrame) -> DataFrame:
    """Durations of the condition labels in seconds, and whether they rise with the row order."""
    earlier = F.lag("seconds").over(Window.partitionBy("exid").orderBy("cond_order"))
    return conditions.withColumn("seconds", duration_seconds("cond")).withColumn(
        "rises", F.coalesce(F.col("seconds") > earlier, F.lit(True))
    )
