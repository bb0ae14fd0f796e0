"""Byte ranges of text files, read line by line inside tasks."""

from __future__ import annotations

import json
import os
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.datasource import InputPartition

from cutgrid.sources import bgzf

READ_BYTES = 8 << 20
#: Text read at first behind the end of a range, where a line is only completed, and at most at once.
FIRST_AHEAD, AHEAD = 1 << 12, 1 << 18


@dataclass
class FileRange(InputPartition):
    """Bytes `start` to `end` of a file; a gzip file is one range from 0 with `end` -1, unless it is `blocked`."""

    path: str
    part: int
    start: int
    end: int
    blocked: bool = False


@dataclass
class Ranges(InputPartition):
    """Ranges that one task reads one after another."""

    ranges: list[FileRange]


def file_system(path: str):
    """File system of a path or URI, and the path inside it, for reading in tasks."""
    from pyarrow import fs

    if "%" in path and ":/" in path:
        path = unquote(path)
    scheme, colon, rest = path.partition(":/")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), os.path.abspath("/" + rest.lstrip("/") if colon else path)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    known = ("s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss")
    if scheme not in known:
        raise ValueError(f"cannot read {scheme}:/ in tasks; known are file and {', '.join(known)}")
    return fs.FileSystem.from_uri(f"{scheme}:/{rest}" if rest.startswith("/") else f"{scheme}:///{rest}")


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """URIs and sizes of a file, a pattern's files, or a folder's files with all its subfolders.

    Names come from the path's own file system, on the driver. A path without any file is an error.
    """
    jvm = spark._jvm
    wanted = jvm.org.apache.hadoop.fs.Path(path)
    system = wanted.getFileSystem(spark._jsc.hadoopConfiguration())
    todo, found = list(system.globStatus(wanted) or []), []
    while todo:
        status = todo.pop()
        if status.getPath().getName().startswith(("_", ".")):
            continue
        if status.isDirectory():
            todo += list(system.listStatus(status.getPath()))
        else:
            found.append((status.getPath().toUri().toString(), status.getLen()))
    if not found:
        raise FileNotFoundError(f"no file for {path}")
    return sorted(found)


def range_options(spark: SparkSession, path: str, range_bytes: int | None) -> dict[str, str]:
    """The files of a path and how they are read in ranges."""
    return file_options(spark, list_files(spark, path), range_bytes)


def file_options(spark: SparkSession, listed: list[tuple[str, int]], range_bytes: int | None) -> dict[str, str]:
    """The files, largest and smallest range, most bytes of a task and the number of cores, from the session's own file settings."""
    files = {"files": json.dumps(listed)}

    def size(key: str, default: str) -> int:
        text = spark.conf.get(key, default).strip().lower().removesuffix("b")
        return int(text[:-1]) << {"k": 10, "m": 20, "g": 30}[text[-1]] if text[-1] in "kmg" else int(text)

    most, cores = size("spark.sql.files.maxPartitionBytes", "128m"), spark.sparkContext.defaultParallelism
    files |= {"task_bytes": str(most), "cores": str(cores)}
    if range_bytes is not None:
        return files | {"range_bytes": str(range_bytes), "least_bytes": str(range_bytes), "slices": "1"}
    return files | {"range_bytes": str(most), "least_bytes": str(size("spark.sql.files.openCostInBytes", "4m")), "slices": str(cores)}


def blocked_here(path: str) -> bool:
    """Whether a file is blocked gzip that tasks can open themselves."""
    try:
        return path.endswith(".gz") and _blocked(path)
    except (ValueError, OSError):
        return False


def _blocked(path: str) -> bool:
    system, inner = file_system(path)
    with system.open_input_file(inner) as file:
        return bgzf.is_blocked(file)


def file_ranges(options: dict[str, str]) -> list[FileRange]:
    """Ranges of all plain and blocked files, small enough to give every core one where the data allow it.

    Any other gzip file is one range; one that is larger than a range is named in a warning.
    """
    files = [(name, size) for name, size in json.loads(options["files"])]
    most, least, slices = (int(options[k]) for k in ("range_bytes", "least_bytes", "slices"))
    kinds = {name: _blocked(name) if name.endswith(".gz") else None for name, _ in files}
    total = sum(size for name, size in files if kinds[name] is not False)
    width = min(most, max(least, total // slices + 1))
    whole = [name for name, size in files if kinds[name] is False and size > width]
    if whole:
        warnings.warn(f"read by one task each, as their gzip has no blocks: {', '.join(whole)}", stacklevel=2)
    ranges = []
    for name, size in files:
        if kinds[name] is False:
            ranges.append(FileRange(name, 0, 0, -1))
        else:
            ranges += [
                FileRange(name, i, s, min(s + width, size), bool(kinds[name])) for i, s in enumerate(range(0, size, width))
            ]
    return ranges


#: Tasks per core up to which every range has its own.
TASKS_A_CORE = 4


def dealt_ranges(options: dict[str, str]) -> list[Ranges]:
    """The ranges by task, in the order of the files.

    A range may be far smaller than what a task should read, so neighbours share a task once there are `TASKS_A_CORE` tasks for every
    core, up to the session's bytes a task. The number of tasks follows the cores and the bytes, not the width of a range.
    """
    ranges = file_ranges(options)
    total = sum(part.end - part.start for part in ranges if part.end >= 0)
    most = min(int(options["task_bytes"]), total // (TASKS_A_CORE * int(options["cores"])) + 1)
    dealt, room = [], 0
    for part in ranges:
        size = most if part.end < 0 else part.end - part.start
        if size > room:
            dealt.append(Ranges([]))
            room = most
        dealt[-1].ranges.append(part)
        room -= size
    return dealt


class RangeBytes:
    """The text of a range and what follows it, in blocks that lie wholly inside or wholly behind the range.

    Places count bytes of text; in a blocked file they count from the place of the range's first member times 65,536, which is
    more than all text before it. `end` is the place where the range ends, None until it is met.
    """

    def __init__(self, part: FileRange) -> None:
        self.part, self.end = part, None
        self.system, self.inner = file_system(part.path)
        #: The byte before the range, empty at the start of the file.
        self.before = b""
        self.start = part.start

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        return self._members() if self.part.blocked else self._stream() if self.part.end < 0 else self._plain()

    def _stream(self) -> Iterator[tuple[int, bytes]]:
        with self.system.open_input_stream(self.inner, compression="gzip") as stream:
            at = 0
            while block := stream.read(READ_BYTES):
                yield at, block
                at += len(block)

    def _plain(self) -> Iterator[tuple[int, bytes]]:
        self.end = self.part.end
        with self.system.open_input_file(self.inner) as file:
            at = self.start
            if at:
                self.before = file.read_at(1, at - 1)
            ahead = FIRST_AHEAD
            while block := file.read_at(min(READ_BYTES, self.end - at) if at < self.end else ahead, at):
                ahead = min(AHEAD, 2 * ahead) if at >= self.end else ahead
                yield at, block
                at += len(block)

    def _members(self) -> Iterator[tuple[int, bytes]]:
        with self.system.open_input_file(self.inner) as file:
            first = bgzf.first_member(file, self.part.start, self.part.end)
            if first is None:
                return
            self.before = bgzf.byte_before(file, first)
            at = self.start = first << 16
            held, size, begun = [], 0, at
            for place, text in bgzf.read(file, first, min(bgzf.READ, self.part.end - first + bgzf.MEMBER)):
                if place >= self.part.end and self.end is None:
                    if held:
                        yield begun, b"".join(held)
                    held, size, begun, self.end = [], 0, at, at
                held.append(text)
                at, size = at + len(text), size + len(text)
                if size >= READ_BYTES or self.end is not None:
                    yield begun, b"".join(held)
                    held, size, begun = [], 0, at
            if held:
                yield begun, b"".join(held)


def line_blocks(text: RangeBytes) -> Iterator[tuple[int, list[bytes]]]:
    """Whole lines from the range's start on, in blocks with the place of the first line.

    Does not stop at the range's end: the caller does, and `text.end` is known when a line behind it is given. A range that begins
    inside a line skips the rest of it, which the range before it owns.
    """
    held, at = [], None
    for place, block in text:
        if at is None:
            at = place
            if text.before not in (b"", b"\n"):
                cut = block.find(b"\n")
                if cut < 0:
                    at = None
                    continue
                at, block = place + cut + 1, block[cut + 1:]
                text.before = b""
            text.before = b""
        cut = block.rfind(b"\n")
        if cut < 0:
            held.append(block)
            continue
        data = b"".join([*held, block[:cut]])
        yield at, data.split(b"\n")
        at += len(data) + 1
        held = [block[cut + 1:]]
    data = b"".join(held)
    if data:
        yield at, data.split(b"\n")
