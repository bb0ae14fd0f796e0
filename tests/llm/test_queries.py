"""The registered text queries: against their SQL, and the pipeline against its stages restated."""

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import TABLES, canonical
from cutgrid.functions.sizing import shared_dir
from cutgrid.llm import catalog, exact_dedup, language, simhash
from cutgrid.llm.catalog import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.test_operators import MODEL, exact, linked_groups


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours, theirs = canonical(QUERIES[name](spark, sf_dir).toPandas()), canonical(con.execute(ORACLES[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True, check_dtype=False)


def test_one_query_for_each_operator():
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def test_pipeline(spark, sf_dir):
    import sentencepiece

    documents = catalog.table(spark, sf_dir, "documents")
    rows = {x.doc_id: x.text for x in documents.collect()}
    rejected = {x.doc_id for x in language.identify(documents, language.fit(documents)).filter("rejected").collect()}
    left = [(i, rows[i]) for i in sorted(rows) if i not in rejected]
    left = [(i, t) for (i, t), row in zip(left, exact(left)) if row[3]]
    left = [(i, t) for (i, t), row in zip(left, linked_groups(left)) if row[2] == i]
    items = [(x.item_id, x.text) for x in catalog.table(spark, sf_dir, "benchmark").collect()]
    left = [(i, t) for i, t in left if not brute.contaminated(t, items)[1]]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    wanted = [(i, len(library.encode(t)), library.encode(t), t) for i, t in left]
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted((x.doc_id, x.n_tokens, x.ids, x.text) for x in found.collect()) == wanted
    assert len(rows) > len(wanted) > len(rows) // 2


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = catalog.table(spark, sf_dir, "documents")
    assert len(corpus_pipeline.STAGES) == 5
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, sf_dir).schema == docs.schema


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Empty tables, repeated rows, rows without id: a defined result, and nothing left behind but the last stage."""
    documents = catalog.table(spark, "/root/testdata/sf0.001", "documents")
    catalog.table(spark, "/root/testdata/sf0.001", "benchmark").write.parquet(str(tmp_path / "a" / "benchmark.parquet"))
    few = documents.filter("doc_id < 60")
    lost = documents.filter("doc_id between 60 and 90").withColumn("doc_id", F.lit(None).cast("long"))
    few.unionByName(few).unionByName(lost).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    twice = sorted((x.doc_id, x.n_tokens) for x in corpus_pipeline.run(spark, str(tmp_path / "a")).filter("doc_id is not null").collect())
    assert len(set(os.listdir(folder)) - before) == 1 and len({i for i, _ in twice}) == len(twice) > 30
    few.unionByName(lost).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    catalog.table(spark, "/root/testdata/sf0.001", "benchmark").limit(0).write.parquet(str(tmp_path / "b" / "benchmark.parquet"))
    once = corpus_pipeline.run(spark, str(tmp_path / "b"))
    assert once.filter("doc_id is null").count() > 10 and {i for i, _ in twice} <= {x.doc_id for x in once.collect()}
    documents.limit(0).write.parquet(str(tmp_path / "c" / "documents.parquet"))
    catalog.table(spark, "/root/testdata/sf0.001", "benchmark").write.parquet(str(tmp_path / "c" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "c")).collect() == []


def test_no_text_is_moved_to_find_repeated_rows(spark, monkeypatch):
    """Whether rows are repeated is asked of ids and digests only."""
    asked = []
    plain = type(spark.range(1)).isEmpty
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda df: asked.append(df) or plain(df))
    documents = catalog.table(spark, "/root/testdata/sf0.001", "documents")
    exact_dedup.drop_copies(documents)
    simhash.drop_near_copies(documents)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in asked]
    assert plans and not any("text#" in plan for plan in plans)
