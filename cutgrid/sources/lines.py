"""Lines of plain and blocked gzip files as a Spark data source, read in byte ranges."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from cutgrid.sources import bgzf, blocks
from cutgrid.sources.blocks import FileRange, RangeBytes, Ranges, dealt_ranges, file_options, line_blocks

#: Bytes of a file that a task reads at most. Blocked gzip holds several times as much text.
RANGE = 8 << 20
BATCH = 1 << 16


def own_lines(part: FileRange) -> Iterator[list[bytes]]:
    """The lines that begin inside the range."""
    text = RangeBytes(part)
    for at, lines in line_blocks(text):
        if text.end is not None and at + sum(map(len, lines)) + len(lines) >= text.end:
            kept, here = 0, at
            while kept < len(lines) and here < text.end:
                here += len(lines[kept]) + 1
                kept += 1
            yield lines[:kept]
            return
        yield lines


class LinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Ranges]:
        return dealt_ranges(self.options)

    def read(self, partition: Ranges):
        import pyarrow as pa

        for part in partition.ranges:
            for lines in own_lines(part):
                for start in range(0, len(lines), BATCH):
                    piece = [line.rstrip(b"\r") for line in lines[start:start + BATCH]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.path] * len(piece), pa.string()), pa.array(piece, pa.binary()).cast(pa.string())], names=["file", "line"])


class LinesSource(DataSource):
    """Data source behind `read_lines`."""

    @classmethod
    def name(cls) -> str:
        return "line_ranges"

    def schema(self) -> str:
        return "file string, line string"

    def reader(self, schema) -> LinesReader:
        return LinesReader(dict(self.options))


def read_lines(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """`file, line` of files given as (URI, size); a task reads at most `RANGE` bytes of plain or blocked files."""
    for module in (bgzf, blocks, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(LinesSource)
    options = file_options(spark, files, None)
    options |= {key: str(min(RANGE, int(options[key]))) for key in ("range_bytes", "least_bytes", "task_bytes")}
    return spark.read.format("line_ranges").options(**options).load()
