"""FASTA as a Spark data source that yields chunks of contigs.

Plain files and blocked gzip files are read as independent byte ranges, wherever lines end: a contig on one line is shared by all
ranges it lies in, and each reads a few letters beyond its end. A range does not know in which contig it begins, nor
whether it begins inside a header, so its first chunks come without a name and with offsets from the range's start; one
summary row per range (letters, last header, what stands at its end) and running totals over these fill both in. Any other gzip file is
one range, read as a stream chunk by chunk.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from cutgrid.functions.sizing import small
from cutgrid.functions.text import first_token
from cutgrid.schemas import FASTA
from cutgrid.sources import bgzf, blocks
from cutgrid.sources.blocks import FileRange, RangeBytes, Ranges, dealt_ranges, range_options

CHUNK = 1 << 16
OVERLAP = 64


#: What stands at the end of a range: a header line, letters, or still the line in whose middle it began.
HEADER, LETTERS, SAME = "header", "letters", "same"


class Chunks:
    """Chunks of one range as (contig header or None before the first one, lead, offset, own letters, text).

    `lead` marks what comes before the first line end of a range that begins inside a line: letters, or the rest of a header, which
    only the ranges before can tell. A contig of which only the header lies in the range has one empty chunk. Nothing longer than a block
    of the file and a chunk is held. `ends` is set when all chunks are taken.
    """

    def __init__(self, part: FileRange, chunk: int, overlap: int) -> None:
        self.text, self.chunk, self.overlap = RangeBytes(part), chunk, overlap
        self.contig: bytes | None = None
        self.start = self.owned = 0
        self.lead: int | None = 0  # letters of the lead, None while it goes on
        self.held = bytearray()
        self.ends = SAME

    def _ready(self, last: bool) -> Iterator[tuple[bytes | None, bool, int, int, bytes]]:
        if last and self.contig is not None and self.start == self.owned == 0:
            yield self.contig, False, 0, 0, b""
        while self.owned:
            leads = self.contig is None and (self.lead is None or self.start < self.lead)
            size = min(self.chunk, self.owned, self.lead - self.start if leads and self.lead is not None else self.chunk)
            ends_lead = leads and self.lead is not None and self.start + size == self.lead
            if not last and (len(self.held) < size + self.overlap or size < self.chunk and not ends_lead):
                return
            yield self.contig, leads, self.start, size, bytes(self.held[:size + self.overlap])
            del self.held[:size]
            self.start, self.owned = self.start + size, self.owned - size

    def __iter__(self) -> Iterator[tuple[bytes | None, bool, int, int, bytes]]:
        header: bytearray | None = None
        fresh, begun, text = True, False, self.text
        for place, block in text:
            own = text.end is None or place < text.end
            if not begun:
                begun, fresh = True, text.before in (b"", b"\n")
                self.lead = 0 if fresh else None
                self.ends = LETTERS if fresh else SAME
            at = 0
            while at < len(block):
                if header is not None or self.lead is None:
                    cut = block.find(b"\n", at)
                    line, at = (block[at:], len(block)) if cut < 0 else (block[at:cut], cut + 1)
                    if header is not None:
                        header += line
                    else:
                        line = line.rstrip(b"\r")
                        self.held += line
                        self.owned += len(line) if own else 0
                    if cut >= 0:
                        fresh = True
                        if header is not None:
                            self.contig, self.start, self.owned, self.held = bytes(header).rstrip(b"\r"), 0, 0, bytearray()
                            header = None
                        else:
                            self.lead = self.start + self.owned
                        if own:
                            self.ends = LETTERS
                elif fresh and block[at:at + 1] == b">":
                    yield from self._ready(True)
                    self.owned, self.held = 0, bytearray()
                    if not own:
                        return
                    header, at, self.ends = bytearray(), at + 1, HEADER
                else:
                    cut = block.find(b"\n>", at)
                    lines, at = (block[at:], len(block)) if cut < 0 else (block[at:cut + 1], cut + 1)
                    fresh = lines.endswith(b"\n")
                    letters = lines.replace(b"\n", b"").replace(b"\r", b"")
                    self.held += letters
                    self.owned += len(letters) if own else 0
                if header is None:
                    yield from self._ready(False)
                    if not own and len(self.held) >= self.owned + self.overlap:
                        yield from self._ready(True)
                        return
        if header is not None:
            self.contig, self.start, self.owned = bytes(header).rstrip(b"\r"), 0, 0
        yield from self._ready(True)


class FastaReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.chunk, self.overlap = options, int(options["chunk"]), int(options["overlap"])

    def partitions(self) -> list[Ranges]:
        return dealt_ranges(self.options)

    def read(self, partition: Ranges):
        for part in partition.ranges:
            yield from self._read(part)

    def _read(self, partition: FileRange):
        found, count = Chunks(partition, self.chunk, self.overlap), 0
        for contig, lead, offset, span, text in found:
            count += 1
            yield (
                partition.path, partition.part, count, None if contig is None else contig.decode(), lead, offset, span,
                text.decode("ascii", "replace" if lead else "strict"), None,
            )
        # One row says how the range ends, so that every range shows up.
        yield partition.path, partition.part, 0, None, False, 0, 0, "", found.ends


class FastaSource(DataSource):
    """Data source behind `read_fasta`."""

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> T.StructType:
        return FASTA

    def reader(self, schema: T.StructType) -> FastaReader:
        return FastaReader(dict(self.options))


def read_fasta(
    spark: SparkSession, path: str, prefix: str = "chr", chunk: int = CHUNK, overlap: int = OVERLAP,
    range_bytes: int | None = None,
) -> DataFrame:
    """Chunk table `chrom, offset, span, seq`; names are `prefix` + the header's first token.

    `overlap` must be at least the length of the longest motif to be searched, less one; `find_motif` checks it.
    """
    for module in (bgzf, blocks, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(FastaSource)
    rows = (
        spark.read.format("fasta").option("chunk", chunk).option("overlap", overlap)
        .options(**range_options(spark, path, range_bytes)).load()
    )
    # Per range: the last contig that begins in it, the letters after that header (or all of them), those of its lead, its end.
    ranges = rows.groupBy("file", "part").agg(
        F.max_by("contig", F.when(F.col("contig").isNotNull(), F.col("ordinal"))).alias("opens"),
        F.max(F.struct("ordinal", (F.col("rel_offset") + F.col("span")).alias("reach"))).alias("tail"),
        F.sum(F.when(F.col("lead"), F.col("span")).otherwise(0)).alias("lead"),
        F.max("ends").alias("ends"),
    )
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.last(F.when(F.col("ends") != SAME, F.col("ends")), ignorenulls=True).over(earlier)
    ranges = ranges.withColumn("_header", F.coalesce(begins == HEADER, F.lit(False))).withColumn(
        "_skipped", F.when(F.col("_header"), F.col("lead")).otherwise(0)
    ).withColumn("_reach", F.col("tail.reach") - F.when(F.col("opens").isNull(), F.col("_skipped")).otherwise(0))
    so_far = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    run = ranges.withColumn("run", F.count("opens").over(so_far))
    before = Window.partitionBy("file", "run").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    reached = run.select(
        "file", "part", "_header", "_skipped", F.first("opens", ignorenulls=True).over(before).alias("_contig"),
        F.sum("_reach").over(before).alias("_base"),
    )
    # What a range inherits is what the range before it has reached.
    inherited = Window.partitionBy("file").orderBy("part")
    reached = reached.select(
        "file", "part", "_header", (F.lag("_base").over(inherited) - F.col("_skipped")).alias("_base"),
        F.lag("_contig").over(inherited).alias("_contig"),
    )
    filled = rows.filter("span > 0").join(small(reached), ["file", "part"], "left").filter("not (lead and _header)")
    inherits = F.col("contig").isNull()
    return filled.select(
        F.concat(F.lit(prefix), first_token(F.coalesce("contig", "_contig"))).alias("chrom"),
        (F.col("rel_offset") + F.when(inherits, F.coalesce("_base", F.lit(0))).otherwise(0)).alias("offset"),
        "span", F.col("seq").alias("seq", metadata={"overlap": overlap}),
    )
