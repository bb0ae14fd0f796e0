"""Alignments as SAM text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cutgrid.functions.text import base_name, library_id
from cutgrid.sources.blocks import blocked_here, list_files
from cutgrid.sources.lines import read_lines


def _lines(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """`value, libid` of all lines; blocked gzip is read in ranges, which the text reader would give to one task a file."""
    try:
        listed = sorted({file for path in paths for file in list_files(spark, path)})
    except FileNotFoundError:  # the text reader says what is missing, or reads a folder without files
        listed = []
    blocked = [(uri, size) for uri, size in listed if blocked_here(uri)]
    others = paths
    if blocked:
        known, hadoop = {uri for uri, _ in blocked}, spark._jvm.org.apache.hadoop.fs
        others = [hadoop.Path(spark._jvm.java.net.URI(uri)).toString() for uri, _ in listed if uri not in known]
    parts = []
    if others:
        parts.append(spark.read.text(others).select("value", library_id("_metadata.file_name", sep).alias("libid")))
    if blocked:
        name = F.url_decode(F.replace(base_name("file"), F.lit("+"), F.lit("%2B")))
        parts.append(read_lines(spark, blocked).select(F.col("line").alias("value"), library_id(name, sep).alias("libid")))
    return reduce(DataFrame.unionByName, parts)


def read_sam(spark: SparkSession, path: str | Sequence[str], sep: str = ".") -> DataFrame:
    """One row per alignment record; the library is the file name up to `sep`. Files are plain or gzip; blocked gzip is read in ranges.

    `multi` tells whether the aligner reported a second place for the read (a score in tag XS).
    """
    lines = _lines(spark, [path] if isinstance(path, str) else list(path), sep)
    fields = F.split("value", "\t", 12)
    return (
        lines.filter(~F.col("value").startswith("@") & (F.col("value") != ""))
        .select("libid", fields.alias("f"))
        .select(
            "libid", F.get("f", F.lit(0)).alias("read_id"), F.get("f", F.lit(1)).try_cast("int").alias("flag"),
            F.get("f", F.lit(2)).alias("chrom"), F.get("f", F.lit(3)).try_cast("long").alias("pos"),
            F.get("f", F.lit(4)).try_cast("int").alias("mapq"), F.get("f", F.lit(5)).alias("cigar"),
            F.get("f", F.lit(6)).alias("rnext"),
            F.coalesce(F.get("f", F.lit(11)).rlike(r"(^|\t)XS:i:"), F.lit(False)).alias("multi"),
        )
    )
