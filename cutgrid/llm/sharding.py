"""Shards of bounded size by extendible hashing.

A document's hash is a string of bits, and the directory is a table from the first bits of the hash to buckets. It begins with as many
bits as the total size asks for. A bucket above the byte limit splits on its next bits, and only its documents are looked at again;
two neighbours that fit together become one bucket of a bit less. So a bucket is the shortest prefix whose documents fit. Nothing
but sums moves, each document is counted once for the first directory and again only where its bucket splits, and the
directory is never held in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import small, stage
from cutgrid.operators.numbering import ranked

SHARD_BYTES = 1 << 20
#: Bits of a hash, and how many a bucket that is too large is split by at once.
BITS, STEP = 60, 4


def bits(doc_id: Column, digest: Column) -> Column:
    """The first `BITS` bits of the md5 of id and content digest."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest)
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    return F.shiftright(F.col("h"), BITS - depth)


def _units(docs: DataFrame) -> DataFrame:
    """doc_id, digest, bytes, copies, h: rows that agree in id and text are one unit."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.md5(text).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    return rows.groupBy("doc_id", "digest", "bytes").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "h", bits(F.col("doc_id"), F.col("digest"))
    )


def _totals(units: DataFrame, depth: int) -> DataFrame:
    """cell, bytes, rows of each prefix of `depth` bits."""
    return units.groupBy(_prefix(depth).alias("cell")).agg(
        F.sum(F.col("bytes") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows")
    )


def _joined(cells: DataFrame, depth: int, limit: int) -> DataFrame:
    """cell, depth, prefix, shard_bytes, shard_rows: the shortest prefix that fits for each cell of `depth` bits that fits itself."""
    found = cells.filter(F.col("bytes") <= limit).select(
        "cell", F.lit(depth).alias("depth"), F.col("cell").alias("prefix"), F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows"))
    level = cells.withColumnRenamed("cell", "prefix")
    for shorter in range(depth - 1, -1, -1):
        level = stage(level.groupBy(F.shiftright("prefix", 1).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        fits = level.filter(F.col("bytes") <= limit)
        if fits.isEmpty():  # then no prefix that is shorter still can fit
            break
        better = fits.select(F.col("prefix").alias("_prefix"), F.col("bytes").alias("_bytes"), F.col("rows").alias("_rows"))
        met = F.col("_prefix").isNotNull()
        found = stage(found.join(better, F.shiftright("cell", depth - shorter) == F.col("_prefix"), "left").select(
            "cell", F.when(met, F.lit(shorter)).otherwise(F.col("depth")).alias("depth"),
            F.coalesce("_prefix", "prefix").alias("prefix"), F.coalesce("_bytes", "shard_bytes").alias("shard_bytes"),
            F.coalesce("_rows", "shard_rows").alias("shard_rows"),
        ))
    return found


def _split(cells: DataFrame, below: int, deepest: int, limit: int) -> DataFrame:
    """The same for cells of `deepest` bits whose prefixes of `below` bits do not fit."""
    paths = cells.select("cell", "bytes", "rows", F.explode(F.sequence(F.lit(below + 1), F.lit(deepest))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {deepest} - depth)"))
    fits = paths.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).filter(F.col("bytes") <= limit)
    return paths.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"]).groupBy("cell").agg(
        F.min(F.struct("depth", "prefix", "bytes", "rows")).alias("found")
    ).select(
        "cell", "found.depth", "found.prefix", F.col("found.bytes").alias("shard_bytes"), F.col("found.rows").alias("shard_rows")
    )


def assign(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, digest, bytes, depth, prefix, page, shard_bytes, shard_rows: one row per row of `docs`.

    A shard is (depth, prefix, page). `page` is empty but where all bits are used up: rows that agree in id and text
    are then cut into pages that fit, and one document above the limit is a page alone. Null texts have no bytes, null ids
    are a value like others, an empty table gives an empty result; only `doc_id` and `text` are read.
    """
    units = stage(_units(docs))
    total = units.agg(F.sum(F.col("bytes") * F.col("copies"))).first()[0] or 0
    below, deepest, left, done = None, min(BITS, max(0, (-(-total // max(1, limit)) - 1).bit_length())), units, None
    while True:
        cells = stage(_totals(left, deepest))
        found = stage(_joined(cells, deepest, limit) if below is None else _split(cells, below, deepest, limit))
        settled = left.withColumn("cell", _prefix(deepest)).join(small(found), "cell").select(
            "doc_id", "digest", "bytes", "copies", "depth", "prefix", F.lit("").alias("page"), "shard_bytes", "shard_rows",
        )
        done = settled if done is None else done.unionByName(settled)
        large = cells.join(found, "cell", "left_anti").select("cell")
        if large.isEmpty():
            left = units.limit(0)
            break
        left = stage(left.withColumn("cell", _prefix(deepest)).join(small(large), "cell", "left_semi").drop("cell"))
        if deepest == BITS:
            break
        below, deepest = deepest, min(BITS, deepest + STEP)
    done = done.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy")
    if left.isEmpty():
        return done
    rows = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))))
    full = left.withColumn("on_page", rows).withColumn(
        "page_number", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.col("on_page"))))
    ).withColumn("shard_rows", F.least("on_page", F.col("copies") - F.col("page_number") * F.col("on_page")))
    pages = full.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "shard_rows"))).select(
        "doc_id", "digest", "bytes", F.lit(BITS).alias("depth"), F.col("h").alias("prefix"),
        F.concat_ws(":", "digest", F.col("page_number").cast("string")).alias("page"),
        (F.col("bytes") * F.col("shard_rows")).alias("shard_bytes"), "shard_rows",
    )
    return done.unionByName(pages)


def write(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """All columns of `docs` as Parquet, one folder per shard, none of more text than `limit` but for a text that is larger itself.

    Rows that agree in id and text and fill several pages are numbered by exact rank, in parts of any size, and dealt to the pages.
    """
    def key(doc_id: Column, digest: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("-")), digest)

    found = stage(assign(docs, limit).withColumn("__key", key(F.col("doc_id"), F.col("digest"))))
    whole = F.concat_ws("-", F.col("depth").cast("string"), F.col("prefix").cast("string"))
    single = found.filter("page = ''").select("__key", whole.alias("__name")).distinct()
    paged = stage(found.filter("page <> ''").groupBy("__key", whole.alias("__whole")).agg(F.max("shard_rows").alias("__on_page")))
    rows = docs.select(
        F.struct(*[docs[name] for name in docs.columns]).alias("__doc"), key(docs["doc_id"], F.md5(F.coalesce(docs["text"], F.lit("")))).alias("__key"))
    placed = rows.join(single, "__key").select("__doc", "__name")
    if not paged.isEmpty():
        numbered = ranked(
            stage(rows.join(small(paged), "__key").withColumn("__row", F.monotonically_increasing_id())), ["__key"], ["__row"])
        page = F.floor(F.col("rank") / F.col("__on_page")).cast("string")
        placed = placed.unionByName(numbered.select(
            "__doc", F.concat_ws("-", "__whole", F.concat_ws(":", F.element_at(F.split("__key", ":"), -1), page)).alias("__name")))
    placed.select("__doc.*", "__name").repartition("__name").write.partitionBy("__name").parquet(path)
