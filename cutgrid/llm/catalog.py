"""One query per text operator over its whole table, and the SQL of those that SQL can say."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from cutgrid.llm import (
    decontaminate, exact_dedup, language, merkle, oracles, packing, pieces, pii, repair, secret_scan, sharding, simhash, suffix_dedup,
    warc,
)
from cutgrid.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[count(kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.n_hit("hits")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_entropy"
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("bytes").alias("n_bytes"), "depth", "prefix", "page", "shard_bytes", "shard_rows"
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.read(warc.write(pages), pages.schema["page_id"].dataType, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id"
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs)).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "rejected"
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(conversations, repair.damaged(conversations))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces_ = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    )
    return pieces_.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", merkle.leaf(F.col).alias("leaf"),
        F.when(tampered, merkle.leaf(lambda name: F.col(name) + 1 if name == "n_chars" else F.col(name))).alias("altered"),
    )
    manifest = merkle.build(leaves)
    return merkle.prove(manifest).select(
        "doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"),
        F.sha2(merkle.digests(F.col("path")), 256).alias("proof_sha256"),
        merkle.fold(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_secret_scan": op4_secret_scan,
    "op5_sharding": op5_sharding,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_pieces": op7_pieces,
    "op8_warc": op8_warc,
    "op9_simhash": op9_simhash,
    "op10_language": op10_language,
    "op11_repair": op11_repair,
    "op12_packing": op12_packing,
    "op13_merkle": op13_merkle,
    "pipeline": pipeline,
}

_WORDS_SQL = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES = {
    "op3_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS_SQL} AS w FROM benchmark),
s AS (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS k FROM s),
k AS (SELECT DISTINCT k FROM p),
t AS (SELECT doc_id, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, k WHERE len(w) >= k),
m AS (SELECT doc_id, i, t.k, item_id FROM t JOIN p ON p.k = t.k AND p.win = array_to_string(w[i:i + t.k - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS pos FROM m) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS c, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, coalesce(c, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op5_sharding": f"""
WITH u AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes, CAST('0x' || substr(md5(
    coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
p AS (SELECT doc_id, bytes, d, h >> (60 - d) AS prefix FROM u, generate_series(0, 20) AS t(d)),
s AS (SELECT d, prefix, sum(bytes) AS total, count(*) AS n FROM p GROUP BY ALL HAVING sum(bytes) <= {sharding.SHARD_BYTES})
SELECT doc_id, bytes AS n_bytes, CAST(min(d) AS INTEGER) AS depth, arg_min(prefix, d) AS prefix, '' AS page,
    CAST(arg_min(total, d) AS BIGINT) AS shard_bytes, arg_min(n, d) AS shard_rows
FROM p JOIN s USING (d, prefix) GROUP BY doc_id, bytes""",
    "op6_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY content) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size,
    doc_id = min(doc_id) OVER (PARTITION BY content) AS kept, sha256(content) AS text_sha256
FROM d""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS stored FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
    CASE WHEN stored <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN stored <> page_id THEN stored END AS refers_to
FROM p LEFT JOIN g ON g.html = p.html""",
}
ORACLES |= {"op11_repair": oracles.REPAIR, "op13_merkle": oracles.MERKLE}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
