"""Exact duplicates of whole texts, with DataFrame functions only.

Copies are combined three times, and each time rows fall together only when digest and full content agree:
within the task that reads them, per salted digest (the salt is the reading task's number modulo `SALTS`), and
over the salts. So a group of copies sends one row per task and then at most `SALTS` rows per group, however large it is.
The decisions go back to the documents by digest. Where one digest stands for several contents the
join compares the contents too; this is decided from the combined table, for all documents alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import stage
from cutgrid.llm.common import kept_once

SALTS = 32


def normalised(text: Column) -> Column:
    """Null is empty; each run of blanks, tabs and line ends is one blank."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_digest(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _contents(docs: DataFrame, digest) -> DataFrame:
    content = normalised(F.col("text"))
    return docs.select("doc_id", content.alias("content")).withColumn("digest", digest(F.col("content")))


def combined(docs: DataFrame, digest=content_digest, salts: int = SALTS) -> DataFrame:
    """digest, content, keep_id, group_size: one row per distinct content."""
    local = _contents(docs, digest).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("digest", "content", "salt").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return salted.repartition(F.col("digest")).groupBy("digest", "content").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def decisions(docs: DataFrame, digest=content_digest, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest: one row per row of `docs`.

    Of equal texts the row with the smallest `doc_id` stays, a null id only where the whole group has none.
    Of repeated rows (same id, same text) exactly one stays. Null and empty text are the same text. An empty
    table gives an empty result. Only `doc_id` and `text` are read, so other columns cannot clash.
    """
    contents = combined(docs, digest, salts)
    by_digest = stage(contents.groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    ))
    rows = _contents(docs, digest)
    plain = by_digest.filter("contents = 1").drop("contents")
    decided = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")).join(plain, "digest")
    clashes = by_digest.filter("contents > 1").select("digest")
    if not clashes.isEmpty():
        told_apart = contents.join(clashes, "digest", "left_semi")
        decided = decided.unionByName(
            rows.groupBy("doc_id", "digest", "content").agg(F.count(F.lit(1)).alias("copies"))
            .join(told_apart, ["digest", "content"]).drop("content")
        )
    return decided.select(
        "doc_id", "keep_id", "group_size", "digest", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    ).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    keep = stage(
        decisions(docs).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy(F.col("doc_id").alias("__keep_id"), F.col("digest").alias("__keep_digest")).agg(F.count(F.lit(1)).alias("__rows"))
    )
    return kept_once(docs, keep, content_digest(normalised(docs["text"])))
