"""FASTQ as a Spark data source.

Plain files and blocked gzip files (see `bgzf`) are read as independent byte ranges. Any other gzip file is one range, read as a
stream, and should be followed by a repartition when a run has fewer files than cores.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from cutgrid.functions.text import first_token, library_id
from cutgrid.schemas import FASTQ
from cutgrid.sources import bgzf, blocks
from cutgrid.sources.blocks import FileRange, RangeBytes, Ranges, dealt_ranges, line_blocks, range_options

BATCH = 1 << 16
#: Bytes of the files for which `partitions` is raised by one.
SPREAD_BYTES = 32 << 20


def first_record(lines: list[bytes]) -> int | None:
    """Index of the first record start: a line with '@' whose second next starts with '+'.

    A quality line may start with '@' as well, but its second next line holds a sequence.
    """
    for i in range(len(lines) - 2):
        if lines[i].startswith(b"@") and lines[i + 2].startswith(b"+"):
            return i
    return None


def records(part: FileRange) -> Iterator[tuple[int, list[bytes]]]:
    """Lines of whole records that start inside the range, with the offset of the first line."""
    pending: list[bytes] = []
    offset = None
    synced = part.start == 0
    text = RangeBytes(part)
    for at, lines in line_blocks(text):
        offset = at if offset is None else offset
        pending += lines
        if not synced:
            start = first_record(pending)
            if start is None:
                continue
            offset += sum(len(line) + 1 for line in pending[:start])
            pending, synced = pending[start:], True
        whole = len(pending) // 4 * 4
        batch, pending = pending[:whole], pending[whole:]
        if text.end is not None and batch:
            size = sum(map(len, batch)) + len(batch)
            if offset + size >= text.end:
                keep, here = 0, offset
                while keep < len(batch) and here < text.end:
                    here += sum(len(line) + 1 for line in batch[keep:keep + 4])
                    keep += 4
                yield offset, batch[:keep]
                return
        yield offset, batch
        offset += sum(map(len, batch)) + len(batch)
    if synced and any(pending):
        raise ValueError(f"{part.path}: last record is incomplete")


class FastqReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Ranges]:
        return dealt_ranges(self.options)

    def read(self, partition: Ranges):
        for part in partition.ranges:
            yield from self._read(part)

    def _read(self, partition: FileRange):
        import pyarrow as pa

        name = partition.path
        for offset, lines in records(partition):
            count = len(lines) // 4
            # Unique and rising within a file: a record is longer than one byte.
            ordinals = range(offset, offset + count)
            for start in range(0, count, BATCH):
                stop = min(start + BATCH, count)
                piece = lines[4 * start:4 * stop]
                heads = [line[1:] for line in piece[0::4]]
                seqs = [line.rstrip(b"\r") for line in piece[1::4]]
                quals = [line.rstrip(b"\r") for line in piece[3::4]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (stop - start), pa.string()),
                        pa.array(ordinals[start:stop], pa.int64()),
                        *[pa.array(column, pa.binary()).cast(pa.string()) for column in (heads, seqs, quals)],
                    ],
                    names=FASTQ_NAMES,
                )


FASTQ_NAMES = list(FASTQ.names)


class FastqSource(DataSource):
    """Data source behind `read_fastq`."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> T.StructType:
        return FASTQ

    def reader(self, schema: T.StructType) -> FastqReader:
        return FastqReader(dict(self.options))


def read_fastq(
    spark: SparkSession, path: str, sep: str = "_", range_bytes: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Reads as `libid, read_id, seq, qual, ord`; the library is the `libid=` folder, else the file name up to `sep`.

    `path` is a file, a pattern, or a folder, with all files in its subfolders.

    `range_bytes` fixes the split size, which otherwise follows the session's file settings. `partitions` spreads the reads over as many
    parts, and over one for each `SPREAD_BYTES` of the files where that is more.
    """
    for module in (bgzf, blocks, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(FastqSource)
    options = range_options(spark, path, range_bytes)
    rows = spark.read.format("fastq").options(**options).load()
    if partitions is not None:
        rows = rows.repartition(max(partitions, -(-sum(size for _, size in json.loads(options["files"])) // SPREAD_BYTES)))
    folder = F.regexp_extract("file", "/libid=([^/]+)/", 1)
    stem = F.regexp_replace("file", r"\.(fastq|fq|txt)(\.gz)?$", "")
    return rows.select(
        F.when(folder != "", folder).otherwise(library_id(stem, sep)).alias("libid"), first_token("header").alias("read_id"), "seq", "qual",
        F.struct("file", "ordinal").alias("ord"),
    )
