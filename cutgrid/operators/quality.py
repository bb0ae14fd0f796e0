"""Read quality profiles per library.

The exploding steps feed partial aggregates in the same stage, so what shuffles is a histogram of a
few thousand rows per task and not one row per base. Quantiles come exact from the histograms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cutgrid.functions.sizing import small, stage
from cutgrid.functions.text import PHRED_OFFSET, phred

# Fixed value: a sequence is over-represented above this share of a library's reads.
OVERREPRESENTED_SHARE = 0.001
#: Entries that a summary of frequent values may hold.
MOST_TRACKED = 1 << 19


def _letters(text: str) -> Column:
    return F.posexplode(F.split(F.col(text), ""))


def quality_histogram(reads: DataFrame) -> DataFrame:
    """Bases per library, position (1-based, not grouped) and quality."""
    letters = reads.select("libid", _letters("qual").alias("pos", "char")).filter("char != ''")
    counts = letters.groupBy("libid", "pos", "char").agg(F.count("*").alias("n"))
    return counts.select("libid", (F.col("pos") + 1).alias("pos"), phred("char").alias("q"), "n")


def quality_by_position(reads: DataFrame) -> DataFrame:
    """Mean, quartiles, 10th and 90th percentile of the quality at every position.

    A percentile is the lowest quality that at least this share of the bases does not exceed.
    """
    ordered = Window.partitionBy("libid", "pos").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("libid", "pos")
    ranked = quality_histogram(reads).withColumn("upto", F.sum("n").over(ordered)).withColumn(
        "total", F.sum("n").over(every)
    )

    def lowest(percent: int, name: str) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("q"))).alias(name)

    return ranked.groupBy("libid", "pos").agg(
        F.sum("n").alias("n"), (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean_q"),
        lowest(10, "p10"), lowest(25, "q1"), lowest(50, "median"), lowest(75, "q3"), lowest(90, "p90"),
    )


def base_composition(reads: DataFrame) -> DataFrame:
    """How often every letter occurs at every position (1-based), and its share."""
    letters = reads.select("libid", _letters("seq").alias("pos", "base")).filter("base != ''")
    counts = letters.groupBy("libid", "pos", "base").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("libid", "pos"))
    return counts.select("libid", (F.col("pos") + 1).alias("pos"), "base", "n", share.alias("share"))


def read_histograms(reads: DataFrame) -> DataFrame:
    """Histograms of read length, GC percent and mean quality: `libid, measure, value, n`."""
    length = F.length("seq")
    gc = length - F.length(F.translate("seq", "GCgc", ""))
    total_q = F.aggregate(F.split("qual", ""), F.lit(0), lambda acc, c: acc + F.ascii(c)) - PHRED_OFFSET * F.length("qual")
    values = {
        "length": length,
        "gc_percent": F.floor(F.try_divide(gc * 100 + F.expr("length(seq) div 2"), length)),
        "mean_quality": F.floor(F.try_divide(total_q, F.length("qual"))),
    }
    entries = [F.struct(F.lit(k).alias("measure"), v.cast("long").alias("value")) for k, v in values.items()]
    measured = reads.select("libid", F.explode(F.array(*entries)).alias("m"))
    return measured.filter("m.value is not null").groupBy("libid", "m.measure", "m.value").agg(
        F.count("*").alias("n")
    )


def sequence_counts(reads: DataFrame) -> DataFrame:
    """Copies of every distinct whole sequence."""
    return reads.groupBy("libid", "seq").agg(F.count("*").alias("n"))


def _digest_counts(reads: DataFrame) -> DataFrame:
    """Copies of every distinct sequence by its 128-bit digest, so whole sequences are not shuffled."""
    return reads.groupBy("libid", F.unhex(F.md5("seq")).alias("digest")).agg(F.count("*").alias("n"))


def duplication_levels(reads: DataFrame) -> DataFrame:
    """Distinct sequences and reads per number of copies."""
    return _digest_counts(reads).groupBy("libid", F.col("n").alias("copies")).agg(
        F.count("*").alias("n_sequences"), F.sum("n").alias("n_reads")
    )


def _candidates(reads: DataFrame, min_share: float) -> DataFrame:
    """libid, h: hashes of all sequences that can make up more than `min_share`, and of few others.

    A summary of frequent values is kept per task and merged, with `tracked` entries; it overrates a value by at most 3.5 / `tracked` of
    all reads. So above a frequent value only values of half that share can stand, and these are at most 2 / `min_share`.
    """
    tracked = 1 << math.ceil(8 / min_share - 1).bit_length()
    if tracked > MOST_TRACKED:  # too rare for a summary: every distinct sequence is counted by its digest
        counts = stage(reads.groupBy("libid", F.xxhash64("seq").alias("h")).agg(F.count("*").alias("n")))
        totals = small(counts.groupBy("libid").agg(F.sum("n").alias("total")))
        return counts.join(totals, "libid").filter(F.col("n") > F.col("total") * min_share).select("libid", "h")
    top = reads.select("libid", F.xxhash64("seq").alias("h")).groupBy("libid").agg(
        F.call_function("approx_top_k", F.col("h"), F.lit(math.ceil(2 / min_share)), F.lit(tracked)).alias("top"))
    return top.select("libid", F.explode("top.item").alias("h"))


def overrepresented(reads: DataFrame, min_share: float = OVERREPRESENTED_SHARE) -> DataFrame:
    """Sequences that make up more than `min_share` of a library's reads.

    A summary of frequent hashes tells which may; only the reads of these are counted, as whole sequences and exactly.
    """
    totals = small(reads.groupBy("libid").agg(F.count("*").alias("total")))
    found = reads.withColumn("h", F.xxhash64("seq")).join(small(_candidates(reads, min_share)), ["libid", "h"], "left_semi")
    return sequence_counts(found).join(totals, "libid").filter(F.col("n") > F.col("total") * min_share).select(
        "libid", "seq", "n", (F.col("n") * 100.0 / F.col("total")).alias("percent")
    )
