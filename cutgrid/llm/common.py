"""What the text operators share: reading a table, and running a function over the texts of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cutgrid.functions.sizing import stage

Work = Callable[[list[str | None]], list[pa.Array]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def with_digest(docs: DataFrame) -> DataFrame:
    """doc_id, text, where `doc_id` is the id and the digest of the text: what is decided for a row holds for that text only."""
    return docs.select(F.struct(F.col("doc_id").alias("id"), _text_digest(F.col("text")).alias("digest")).alias("doc_id"), "text")


def without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of `docs` whose id and text are not among the `doc_id` of `decided`, made from `with_digest(docs)`."""
    gone = stage(decided.select(
        F.col("doc_id.id").alias("__gone_id"), F.col("doc_id.digest").alias("__gone_digest")
    ).distinct())
    return docs.join(
        gone, docs["doc_id"].eqNullSafe(gone["__gone_id"]) & (_text_digest(docs["text"]) == gone["__gone_digest"]), "left_anti"
    )


def kept_once(docs: DataFrame, keep: DataFrame, digest: Column) -> DataFrame:
    """The rows of `docs` whose id and `digest` are in `keep` (__keep_id, __keep_digest, __rows), one where `__rows` rows are alike.

    Only rows that have a like are told apart by their digest, so no text is moved for that.
    """
    def those(some: DataFrame) -> DataFrame:
        return docs.join(some, docs["doc_id"].eqNullSafe(some["__keep_id"]) & (digest == some["__keep_digest"]), "left_semi")

    if keep.filter("__rows > 1").isEmpty():
        return those(keep)
    several = those(keep.filter("__rows > 1")).withColumn("__digest", digest).dropDuplicates(["doc_id", "__digest"])
    return those(keep.filter("__rows = 1")).unionByName(several.drop("__digest"))


#: Rows that a task works on at once.
ROWS = 1024


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def map_texts(docs: DataFrame, begin: Callable[[], Work], fields: list[T.StructField]) -> DataFrame:
    """`doc_id` and the columns that `begin()(texts)` returns for the texts of one Arrow batch.

    `begin` runs once per task, so tables and caches are built there and bounded there. Every row of `docs` gives one row,
    `ROWS` at a time, so results do not pile up; other columns are neither read nor returned.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = begin()
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), *work(batch.column(1).to_pylist())], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
