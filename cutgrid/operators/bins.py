"""Genomic bins and the counts in them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import broadcast_limit, measured, small, stage, tasks_for
from cutgrid.operators.intervals import totals_below
from cutgrid.params import BinTag

WHOLE_CHROMOSOME = "chromosome"
BIN = ["bin_tag", "chrom", "start"]
SPAN = [*BIN, "end"]


def keep_chroms(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.filter(F.col("chrom").isin(*names))


def make_bins(sizes: DataFrame, tags: Sequence[BinTag], elongate: bool = False) -> DataFrame:
    """All sliding bins of all tags along every chromosome: `bin_tag, chrom, start, end`.

    The last bins stop at the chromosome end, or keep their full size with `elongate`.
    """
    tag = F.explode(F.array(*[
        F.struct(F.lit(t.label).alias("bin_tag"), F.lit(t.size).cast("long").alias("size"),
                 F.lit(t.step).cast("long").alias("step")) for t in tags
    ]))
    end = F.col("start") + F.col("t.size")
    return (
        sizes.select("chrom", F.col("end").cast("long").alias("length"), tag.alias("t"))
        .filter("length > 0")
        .withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.col("t.step"))))
        .select("t.bin_tag", "chrom", "start", (end if elongate else F.least(end, F.col("length"))).alias("end"))
    )


def chromosome_bins(sizes: DataFrame) -> DataFrame:
    return sizes.select(
        F.lit(WHOLE_CHROMOSOME).alias("bin_tag"), "chrom", F.lit(0).cast("long").alias("start"),
        F.col("end").cast("long").alias("end"),
    )


def bin_starts(position: Column, size: int, step: int) -> Column:
    """Starts of all bins of a tag that hold a position; null for a negative position."""
    first = F.greatest(F.lit(0).cast("long"), F.floor((position - size) / step).cast("long") + 1)
    last = F.floor(position / step).cast("long")
    return F.when(position >= 0, F.sequence(first * step, last * step, F.lit(step).cast("long")))


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda start: F.struct(F.lit(label).alias("bin_tag"), start.alias("start")))


def count_slots(
    counts: DataFrame, grain: int, by: Sequence[str], start: str = "start", reads: str | None = "score"
) -> DataFrame:
    """Reads and sites per slot of `grain` bases."""
    slot = (F.floor(F.col(start) / grain) * grain).cast("long").alias("slot")
    totals = [F.count("*").alias("sites")]
    if reads is not None:
        totals.insert(0, F.sum(reads).alias("reads"))
    return counts.groupBy(*by, "chrom", slot).agg(*totals)


def count_in_bins(
    counts: DataFrame, tags: Sequence[BinTag], by: Sequence[str] = ("libid",), chromosome_wide: bool = False,
    reads: str | None = "score",
) -> DataFrame:
    """Reads and sites per bin, for all tags at once. `counts` has one row per site.

    Sites are first added up in slots that divide every bin of every tag, which is the only step that
    shuffles the whole table. Copying into overlapping bins happens to slots, not to sites or reads.
    """
    grain = reduce(math.gcd, [t.grain for t in tags]) if tags else 1 << 20
    slots = count_slots(counts, grain, by, reads=reads)
    targets = [_labelled(bin_starts(F.col("slot"), t.size, t.step), t.label) for t in tags]
    if chromosome_wide:
        targets.append(F.array(F.struct(
            F.lit(WHOLE_CHROMOSOME).alias("bin_tag"), F.lit(0).cast("long").alias("start")
        )))
    totals = [F.sum(c).alias(c) for c in (["reads", "sites"] if reads is not None else ["sites"])]
    return (
        slots.withColumn("_b", F.explode(F.concat(*targets) if len(targets) > 1 else targets[0]))
        .groupBy(*by, F.col("_b.bin_tag").alias("bin_tag"), "chrom", F.col("_b.start").alias("start"))
        .agg(*totals)
    )


def count_in_regions(
    counts: DataFrame, regions: DataFrame, by: Sequence[str] = ("libid",), start: str = "start"
) -> DataFrame:
    """Reads and sites per custom region (`region_start`, `region_end`) that has any site.

    A region's total is what lies before its end less what lies before its start, so regions may
    overlap as much as they like. Points and totals are staged, so `counts` is scanned once.
    """
    spans = stage(regions.select("chrom", "region_start", "region_end").filter("region_end > region_start").distinct())
    points = stage(counts.groupBy(*by, "chrom", start).agg(F.sum("score").alias("reads"), F.count("*").alias("sites")))
    edges = spans.select("chrom", F.explode(F.array("region_start", "region_end")).alias("edge"))
    below = stage(totals_below(points, edges, by, start, ["reads", "sites"]))
    keys = [*by, "chrom"]
    low = below.select(
        *keys, F.col("edge").alias("region_start"), F.col("reads_below").alias("_r0"), F.col("sites_below").alias("_s0")
    )
    high = below.select(
        *keys, F.col("edge").alias("region_end"), F.col("reads_below").alias("_r1"), F.col("sites_below").alias("_s1")
    )
    return (
        spans.join(low, ["chrom", "region_start"]).join(high, [*keys, "region_end"])
        .select(*keys, "region_start", "region_end", (F.col("_r1") - F.col("_r0")).alias("reads"),
                (F.col("_s1") - F.col("_s0")).alias("sites"))
        .filter("sites > 0")
    )


def for_each_library(rows: DataFrame, libraries: DataFrame) -> DataFrame:
    """Every row once per library (`libid`): the list of libraries is a scalar of the plan, not of the driver."""
    listed = libraries.select("libid").distinct().agg(F.sort_array(F.collect_list("libid"))).scalar()
    return rows.select("*", F.explode(listed).alias("libid"))


def universe_sites(counts: DataFrame, sites: DataFrame, libraries: DataFrame) -> DataFrame:
    """Every site of the domain with every library's count, 0 where it has none.

    The rows are sites times libraries by definition of a universe. Sites and counts are staged and counted first: counts below the
    session's limit are broadcast, others are joined in tasks of about `TASK_ROWS` rows of both sides, however many rows there are.
    """
    key = ["libid", "chrom", "start"]
    counts, n_counts, size = measured(counts.select(*key, "score"))
    domain, n_sites, _ = measured(sites.select("chrom", "start").distinct())
    every = for_each_library(domain, libraries)
    if size <= broadcast_limit(counts.sparkSession):
        counts = F.broadcast(counts)
    else:
        rows = n_counts + n_sites * libraries.select("libid").distinct().count()
        tasks = tasks_for(counts.sparkSession, rows)
        every, counts = every.repartition(tasks, *key), counts.repartition(tasks, *key).hint("merge")
    return every.join(counts, key, "left").select(*key, F.coalesce("score", F.lit(0).cast("long")).alias("score"))


def library_totals(counts: DataFrame, by: Sequence[str] = ("libid",)) -> DataFrame:
    """Reads per library, or per library and chromosome: the denominators of the rates."""
    return counts.groupBy(*by).agg(F.sum("score").alias("total_reads"))


def with_conditions(counts: DataFrame, conditions: DataFrame) -> DataFrame:
    """Attach experiment and condition order to per-library counts."""
    return counts.join(small(conditions.select("exid", "cond", "cond_order", "libid")), "libid")
