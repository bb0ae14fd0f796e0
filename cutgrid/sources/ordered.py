"""Text files whose lines stand in order and may be longer than memory.

Lines come in pieces: `libid`, `opens` (the piece begins a line), `text`, and the columns that order them. Pieces are sorted over
range partitions; each task appends its pieces to a part file per library, line end before line begin, and reports whether its first
piece opened a line. Parts are then put behind one another by one copying task per file: all parts of a library, or only those that
share a line. Compressed parts are blocked gzip, so a copy needs no inflating and the file can be read in ranges again.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import compute as pc, fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cutgrid.functions.sizing import shuffles_freed
from cutgrid.sources import bgzf, blocks
from cutgrid.sources.blocks import file_system

#: Text gathered before it is compressed and written.
FLUSH = 1 << 20
_COPY = 8 << 20


@dataclass
class Parts(WriterCommitMessage):
    """(file, task, path, whether its first piece opens a line) of each part that a task has written."""

    parts: list[tuple[str, int, str, bool]]


class PartFile:
    """Appends pieces of lines; holds at most `FLUSH` bytes and one piece."""

    def __init__(self, path: str, level: int | None) -> None:
        system, inner = file_system(path)
        self.out, self.level, self.held, self.size, self.empty = system.open_output_stream(inner), level, [], 0, True

    def add(self, opens: bool, text: str) -> None:
        self._append(b"\n" + text.encode() if opens and not self.empty else text.encode())

    def add_all(self, opens: pa.Array, texts: pa.Array) -> None:
        """The same for many pieces: they are joined in Arrow, as many at a time as are about `FLUSH` bytes."""
        if texts.null_count:
            raise ValueError("a piece of a line has no text")
        step = max(1, FLUSH * len(texts) // max(1, pc.sum(pc.binary_length(texts)).as_py()))
        for at in range(0, len(texts), step):
            ends, piece = opens.slice(at, step).to_pylist(), texts.slice(at, step)
            if self.empty:
                ends[0] = False
            joined = pc.binary_join_element_wise(pa.array(["\n" if end else "" for end in ends], piece.type), piece, "")
            self._append(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined), "")[0].as_buffer().to_pybytes())

    def _append(self, piece: bytes) -> None:
        self.empty = False
        self.held.append(piece)
        self.size += len(piece)
        if self.size >= FLUSH:
            self._flush()

    def _flush(self) -> None:
        data = b"".join(self.held)
        self.out.write(data if self.level is None else bgzf.members(data, self.level))
        self.held, self.size = [], 0

    def close(self) -> None:
        self._flush()
        self.out.close()


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.level = int(options["level"]) if "level" in options else None

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        task, parts, current, out = TaskContext.get().partitionId(), [], None, None
        try:
            for batch in iterator:
                libids, opens, texts = batch.columns
                start = 0
                for run in pc.run_end_encode(libids).run_ends.to_pylist() if len(libids) else ():
                    libid = libids[start].as_py()
                    if out is None or libid != current:
                        if out is not None:
                            out.close()
                        path = f"{self.folder}/{task}-{uuid.uuid4().hex}"
                        current, out = libid, PartFile(path, self.level)
                        parts.append((libid, task, path, opens[start].as_py()))
                    out.add_all(opens.slice(start, run - start), texts.slice(start, run - start))
                    start = run
        finally:
            if out is not None:
                out.close()
        return Parts(parts)

    def commit(self, messages: list[Parts | None]) -> None:
        listed = [part for message in messages if message for part in message.parts]
        system, inner = file_system(self.folder)
        with system.open_output_stream(f"{inner}/parts.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list[Parts | None]) -> None:
        """Parts without a list are never read; their folder stays for who looks into the failure."""


class PartsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_parts"

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        return PartsWriter(dict(self.options))


def _chains(parts: list[tuple[str, int, str, bool]], whole: bool) -> list[tuple[str, int, list[tuple[str, bool]]]]:
    """(library, number, its parts in order): all of a library, or those that share lines."""
    chains = []
    for libid, task, path, opens in sorted(parts):
        if chains and chains[-1][0] == libid and (whole or not opens):
            chains[-1][2].append((path, opens))
        else:
            chains.append((libid, task, [(path, opens)]))
    return chains


def _put_together(target: str, parts: list[tuple[str, bool]], blocked: bool) -> int:
    """Copy the parts to `target`, with line ends between lines. Until all is there the copy lies with the parts, so nothing of an
    attempt that was lost is seen."""
    system, inner = file_system(target)
    line_end, closing = (bgzf.member(b"\n"), bgzf.END) if blocked else (b"\n", b"")
    system.create_dir(inner.rpartition("/")[0])
    passing, size = f"{file_system(parts[0][0])[1].rpartition('/')[0]}/copy-{uuid.uuid4().hex}", 0
    with system.open_output_stream(passing) as out:
        for number, (path, opens) in enumerate(parts):
            if number and opens:
                out.write(line_end)
            with system.open_input_stream(file_system(path)[1]) as part:
                while block := part.read(_COPY):
                    out.write(block)
                    size += len(block)
        out.write(line_end + closing)
    if system.get_file_info(inner).type != fs.FileType.NotFound:  # another attempt of this task was quicker
        system.delete_file(inner)
    system.move(passing, inner)
    return size


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _made(spark: SparkSession, path: str) -> str:
    """`path` as its own file system names it, and made there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(where)
    return system.makeQualified(where).toUri().toString()


def write_ordered(
    pieces: DataFrame, path: str, order: Sequence[str], name: str = "{libid}.txt", whole: bool = True, compress: bool = True,
    level: int = 6, mode: str = "error",
) -> None:
    """Lines in `order` within each `libid`; `whole`: one file `name` per library, else files in a folder `libid=` each.

    `pieces` has libid, opens and text. A line of any length is written piece by piece. `compress`
    makes blocked gzip of `level` and adds `.gz`. A path that exists is an error unless `mode` is `append`. `libid` names a
    file, so it must not hold a slash; null is written as `null`.
    """
    for module in (bgzf, blocks, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    spark = pieces.sparkSession
    if mode != "append" and _exists(spark, path):
        raise FileExistsError(path)
    spark.dataSource.register(PartsSource)
    library = F.coalesce(F.col("libid").cast("string"), F.lit("null"))
    root = _made(spark, path)
    folder = _made(spark, f"{root}/_parts-{uuid.uuid4().hex}")
    ordered = pieces.withColumn("libid", library).repartitionByRange("libid", *order).sortWithinPartitions("libid", *order)
    options = {"level": str(level)} if compress else {}
    with shuffles_freed(spark):
        ordered.select("libid", "opens", "text").write.format("text_parts").mode("append").options(path=folder, **options).save()
    system, inner = file_system(folder)
    with system.open_input_stream(f"{inner}/parts.json") as listed:
        parts = json.loads(listed.read())
    if named := sorted({part[0] for part in parts if "/" in part[0]}):
        raise ValueError(f"libraries that cannot name a file: {named}")
    suffix = ".gz" if compress else ""
    files = [
        (f"{root}/{name.format(libid=libid)}{suffix}" if whole else f"{root}/libid={libid}/part-{number:05d}.txt{suffix}", chain)
        for libid, number, chain in _chains(parts, whole)
    ]
    if files:
        rows = spark.createDataFrame(files, "target string, parts array<struct<path:string,opens:boolean>>")

        def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    size = _put_together(row["target"], [(p["path"], p["opens"]) for p in row["parts"]], compress)
                    yield pa.RecordBatch.from_pydict({"target": [row["target"]], "bytes": [size]})

        # `collect` brings a name and a size per file.
        with shuffles_freed(spark):
            rows.repartition(min(len(files), 10_000), "target").mapInArrow(copy, "target string, bytes long").collect()
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def line_pieces(lists: DataFrame, keys: Sequence[str], head: Column, items: Sequence[str], tail: Column | None = None, sep: str = "\t") -> DataFrame:
    """Pieces of one line per group: `head`, each list of `items` joined with blanks, and `tail`, with `sep` between them.

    `lists` has `chunk` and the lists of that stretch of the group. Columns: keys, field, chunk, opens, text.
    """
    fields = [
        F.struct(
            F.lit(number).alias("field"), F.lit(number == 0) & (F.col("chunk") == 0), F.concat(
                F.when(F.col("chunk") > 0, " ").otherwise(F.concat(head, F.lit(sep)) if number == 0 else F.lit(sep)),
                F.array_join(item, " "),
            ).alias("text"),
        )
        for number, item in enumerate(items)
    ]
    if tail is not None:
        fields.append(F.when(F.col("chunk") == 0, F.struct(F.lit(len(items)).alias("field"), F.lit(False), F.concat(F.lit(sep), tail).alias("text"))))
    fields = [field.cast("struct<field:int,opens:boolean,text:string>") for field in fields]
    made = lists.select(*keys, "chunk", F.explode(F.array(*fields)).alias("piece")).filter(F.col("piece").isNotNull())
    return made.select(*keys, "piece.field", "chunk", "piece.opens", "piece.text")
