"""Checked broadcasts and cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

_ROW_OVERHEAD = 48
TASK_ROWS = 1 << 20


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own limit for broadcast tables, in bytes; 0 when broadcasts are switched off."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"k": 10, "m": 20, "g": 30}
    text = limit.strip().lower().removesuffix("b")
    if text and text[-1] in units:
        return int(text[:-1]) << units[text[-1]]
    return max(0, int(text))


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        size = size + 16
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, (T.LongType, T.DoubleType)):
            size = size + 8 * F.coalesce(F.size(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            raise TypeError(f"no size estimate for column {field.name}")
    return size.cast("long")


def measured(df: DataFrame) -> tuple[DataFrame, int, int]:
    """`df` evaluated once and staged, with its rows and approximate bytes."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")))
    return staged, seen.get["rows"] or 0, seen.get["bytes"] or 0


def small(df: DataFrame) -> DataFrame:
    """Hint a broadcast, but only after measuring that `df` stays below the session's limit.

    `df` is evaluated once, here. A larger table comes back without a hint, so the join shuffles.
    Meant for sides that do not grow with the reads: configurations, masks, totals per library.
    """
    staged, _, size = measured(df)
    return F.broadcast(staged) if size <= broadcast_limit(df.sparkSession) else staged


def join_hint(spark: SparkSession, size: int) -> str:
    """The join that a side of `size` measured bytes gets: a broadcast up to the session's limit, a shuffle above."""
    return "broadcast" if size <= broadcast_limit(spark) else "merge"


def sized(df: DataFrame) -> DataFrame:
    """`df` evaluated once and staged, with the join that its measured size asks for.

    For rows that a plan makes by itself, like bins out of chromosome lengths: the planner takes them for as few bytes as what they are
    made of, and would broadcast any number of them.
    """
    staged, _, size = measured(df)
    return staged.hint(join_hint(df.sparkSession, size))


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks of at most about `TASK_ROWS` rows, one per core or more.

    For `repartition`: partitions of a plain shuffle are merged until there is one per core, so a task would grow with the tables.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def _in_process(master: str) -> bool:
    """Whether driver and executors are one process; `local-cluster` starts executors of its own."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`.

    Only a local session may go without that setting; it gets a fresh folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not _in_process(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="cutgrid-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scope:
    """Paths that are deleted when the scope ends."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> tuple[DataFrame, str]:
        """`df` staged outside the scope, and its path."""
        path = f"{shared_dir(self.spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
        return _staged(df, path), path

    def add(self, path: str) -> None:
        self.paths.append(path)


_SCOPE: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def owned(spark: SparkSession) -> Iterator[Scope]:
    """What is staged inside is deleted at the end, so whatever is made of it must be written by then."""
    scope = Scope(spark)
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in scope.paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (scope := _SCOPE.get()) is not None:
        scope.add(path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a query inside has shuffled is deleted when it ends, and not once the driver happens to collect its garbage."""
    kept = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if kept is None else spark.conf.set(_CLEANUP, kept)


def _staged(df: DataFrame, path: str) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Write `df` once as Parquet in the shared folder, so that later readers start from files.

    The columns stay prunable, a lost executor costs nothing but a read, and no lineage is kept. The files stay unless the call
    is made in a scope (`owned`).
    """
    return _staged(df, fresh_dir(df.sparkSession, "stage"))
