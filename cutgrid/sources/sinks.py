"""Text exports. Parquet is the native form; these are for tools that expect the text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.operators.reads import flagged_name
from cutgrid.operators.summary import as_text
from cutgrid.sources.ordered import line_pieces, write_ordered

#: Names of gzip levels in the settings of the text writers, from 0.
_LEVELS = ("NO_COMPRESSION", "BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION")


def write_tsv(
    df: DataFrame, path: str, compress: bool = True, header: bool = False, partition_by: Sequence[str] = (),
    sep: str = "\t", mode: str = "error", level: int = 6,
) -> None:
    """A text table in part files; `level` is that of gzip, 0 to 9."""
    writer = (
        df.write.mode(mode).option("sep", sep).option("quote", "").option("escape", "").option("header", header)
        .option("emptyValue", "").option("nullValue", "").option("compression", "gzip" if compress else "none")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("zlib.compress.level", _LEVELS[level])
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def joined(column: str) -> Column:
    return F.array_join(column, " ").alias(column)


def write_grouped(grouped: DataFrame, path: str, pos: str = "pos", sep: str = "\t", **options) -> None:
    """Grouped or merged UMIs, one line per group, sorted by library, chromosome (as text) and position.

    A group's line is written stretch by stretch, so it may be longer than memory. `options` as for `write_ordered`;
    without them a library is a folder `libid=` of files.
    """
    order = ["chrom", pos, *(["read_pos"] if "read_pos" in grouped.columns else [])]
    head = F.concat_ws(sep, "chrom", F.col(pos).cast("string"))
    pieces = line_pieces(grouped, ["libid", *order], head, ["umi", "qual"], sep=sep)
    write_ordered(pieces, path, [*order, "field", "chunk"], **{"whole": False, **options})


def write_assigned(merged: DataFrame, orphans: DataFrame, folder: str, name: str, **options) -> None:
    """Kept sites under `name` and orphan positions (`orphan_groups`) under `orphan.<name>`."""
    write_grouped(merged, f"{folder}/{name}", pos="site", **options)
    write_grouped(orphans, f"{folder}/orphan.{name}", **options)


def write_reads(reads: DataFrame, path: str, pattern: str | None = None, whole: bool = False, **options) -> None:
    """Reads as FASTQ text per library, and per `status` if there is one; flags go into the names.

    A record is one value with line breaks in it, so the four lines of a read stay together. With `whole` a library is one
    file `<libid>.fastq.gz` of blocked gzip, or `<libid>.<status>.fastq.gz`, in the order of the read names.
    """
    name = flagged_name(pattern) if pattern else F.col("read_id")
    record = F.concat(F.lit("@"), name, F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    groups = [c for c in ("libid", "status") if c in reads.columns]
    if whole:
        pieces = reads.select(F.concat_ws(".", *groups).alias("libid"), "read_id", F.lit(True).alias("opens"), record.alias("text"))
        write_ordered(pieces, path, ["read_id"], **{"name": "{libid}.fastq", **options})
        return
    compression = "gzip" if options.get("compress", True) else "none"
    reads.select(*groups, record.alias("value")).write.mode(options.get("mode", "error")).option(
        "compression", compression
    ).option("zlib.compress.level", _LEVELS[options.get("level", 6)]).partitionBy(*groups).text(path)


def write_dedup(lists: DataFrame, path: str, **options) -> None:
    """Deduplicated sites, one line each: chromosome, position, unique UMIs, their number; written as `write_grouped` does."""
    head = F.concat_ws("\t", "chrom", F.col("site").cast("string"))
    pieces = line_pieces(lists, ["libid", "chrom", "site"], head, ["umis"], F.col("counts").cast("string"))
    write_ordered(pieces, path, ["chrom", "site", "field", "chunk"], **{"whole": False, **options})


def write_site_bed(bed: DataFrame, path: str, whole: bool = False, **options) -> None:
    """Five-column BED per library, in row-number order: a folder `libid=` of files each, or with `whole` one file `<libid>.bed.gz`."""
    if whole:
        line = F.concat_ws("\t", "chrom", *[F.col(c).cast("string") for c in ("start", "end")], "name", F.col("score").cast("string"))
        pieces = bed.select("libid", "chrom", "start", F.lit(True).alias("opens"), line.alias("text"))
        write_ordered(pieces, path, ["chrom", "start"], **{"name": "{libid}.bed", **options})
        return
    lines = bed.orderBy("libid", "chrom", "start").select("libid", "chrom", "start", "end", "name", "score")
    write_tsv(lines, path, partition_by=["libid"], **options)


def write_summary(summary: DataFrame, path: str, **options) -> None:
    """Summary table with header, sorted by library; it has one row per library, so one file."""
    write_tsv(as_text(summary).coalesce(1), path, compress=False, header=True, **options)


def write_scores(scores: DataFrame, path: str, **options) -> None:
    """Rescaled scores, one folder per experiment and bin tag."""
    lines = scores.withColumn("bin_tag", F.concat(F.lit("rescaled.bins_"), F.col("bin_tag")))
    write_tsv(
        lines.repartition("exid", "bin_tag", "chrom").sortWithinPartitions("chrom", "start"),
        path, header=True, partition_by=["exid", "bin_tag"], **options,
    )
