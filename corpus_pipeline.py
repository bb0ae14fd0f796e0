"""A corpus run: five stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cutgrid.functions.sizing import owned
from cutgrid.llm import decontaminate, exact_dedup, language, pieces, simhash
from cutgrid.llm.common import table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is recognised."""
    return language.drop_rejected(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.decode(pieces.encode(docs, model), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text"
    )


STAGES = [
    ("language identification", keep_languages),
    ("exact deduplication", drop_copies),
    ("SimHash near-duplicates", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", to_pieces),
]

#: Hashes, character models and merges have no SQL; tests hold `run` against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, text of every document that all stages keep.

    What a stage has put aside, and the documents it read, are deleted when its own documents are written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, function in STAGES:
        with owned(spark) as scope:
            if before is not None:
                scope.add(before)
            docs, before = scope.keep(function(spark, docs, sf_dir))
    return docs
