"""Readers of the text tables: fixed schemas, tab-separated, no quoting, gzip by file suffix."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cutgrid import schemas
from cutgrid.functions.sizing import small
from cutgrid.functions.text import base_name, first_token, library_id, whole_number
from cutgrid.sources.blocks import blocked_here, list_files
from cutgrid.sources.lines import read_lines

Paths = str | Sequence[str]


def read_tsv(
    spark: SparkSession, path: Paths, schema: T.StructType, header: bool = False, sep: str = "\t", mode: str = "FAILFAST"
) -> DataFrame:
    """A text table. Quotes have no meaning: quality texts may contain them. A malformed line fails the job."""
    return (
        spark.read.schema(schema).option("sep", sep).option("header", header).option("quote", "")
        .option("escape", "").option("enforceSchema", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).option("mode", mode).csv(list(path) if not isinstance(path, str) else path)
    )


def input_order() -> Column:
    """Place of a row in its input: file, start of the split in the file, place in the split.

    Splits may be read in any order, so the running id alone does not follow the file.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def file_library() -> Column:
    """Library of the file a row comes from: its `libid=` folder, else its name up to the first dot."""
    folder = F.regexp_extract("_metadata.file_path", "/libid=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(library_id("_metadata.file_name", "."))


def read_stranded_umis(spark: SparkSession, plus: Paths, reverse: Paths, sep: str = "\t") -> DataFrame:
    """UMI lists of both strands as one long table; the library is the file name up to its first dot."""
    def one(path: Paths, strand: str) -> DataFrame:
        rows = read_tsv(spark, path, schemas.STRANDED_UMIS, sep=sep)
        return rows.select(
            file_library().alias("libid"), "chrom", "pos", F.lit(strand).alias("strand"),
            F.col("seq").alias("umi"), "qual", input_order().alias("ord"),
        )

    return one(plus, "+").unionByName(one(reverse, "-"))


def read_grouped_umis(spark: SparkSession, path: Paths, sep: str = "\t") -> DataFrame:
    """Grouped UMI lists as one row per read: `libid, chrom, pos, strand, umi, qual, ord`.

    The lists no longer tell the strand, so it is empty; `ord` is the place of the line in its file
    and of the read in its line.
    """
    rows = read_tsv(spark, path, schemas.GROUPED_UMIS, sep=sep)
    pairs = F.arrays_zip(F.split("seq", " ").alias("umi"), F.split("qual", " ").alias("qual"))
    return rows.select(
        file_library().alias("libid"), "chrom", "pos", input_order().alias("line"),
        F.posexplode(pairs).alias("place", "pair"),
    ).select(
        "libid", "chrom", "pos", F.lit("").alias("strand"), F.col("pair.umi").alias("umi"),
        F.col("pair.qual").alias("qual"), F.struct("line", "place").alias("ord"),
    )


def read_dedup_umis(spark: SparkSession, path: Paths) -> DataFrame:
    """Deduplicated sites; numbers may be padded with blanks."""
    rows = read_tsv(spark, path, schemas.DEDUP_UMIS)
    return rows.select(
        file_library().alias("libid"), F.trim("chrom").alias("chrom"),
        whole_number("pos").alias("pos"), F.split(F.trim("seq"), " ").alias("umis"),
        whole_number("counts").alias("counts"),
    )


def read_bed(spark: SparkSession, path: Paths, columns: int = 4) -> DataFrame:
    """BED with 3 to 5 columns; the chromosome is the name up to its first blank."""
    schema = {3: schemas.BED3, 4: schemas.BED4, 5: schemas.BED5}[columns]
    rows = read_tsv(spark, path, schema)
    return rows.withColumn("chrom", first_token("chrom"))


def read_config(spark: SparkSession, path: Paths) -> DataFrame:
    """Library and barcode: the first two fields of every line, trimmed; blank lines are skipped."""
    rows = read_tsv(spark, path, schemas.CONFIG, mode="PERMISSIVE")
    return rows.select(F.trim("libid").alias("libid"), F.trim("barcode").alias("barcode")).filter("libid != ''")


def read_conditions(spark: SparkSession, path: str) -> DataFrame:
    """Condition table in row order, weak first; columns by the names in its header, in any order.

    The path column may be called `fpath` or `path`. A condition table has a row per library of an experiment. It is
    read as one text, which keeps the row order, and that order becomes `cond_order` (from 1, per experiment).
    """
    text = spark.read.text(path, wholetext=True).select(F.split("value", "\r?\n").alias("lines"))
    lines = text.select(
        F.transform(F.split(F.get("lines", F.lit(0)), "\t"), lambda name: F.lower(F.trim(name))).alias("header"),
        F.posexplode("lines").alias("line_no", "line"),
    ).filter("line_no > 0 and trim(line) != ''")
    fields = F.split("line", "\t")

    def column(*names: str) -> Column:
        places = [F.nullif(F.array_position("header", F.lit(name)).cast("int"), F.lit(0)) for name in names]
        place = F.coalesce(*places, F.raise_error(F.lit(f"no column {' or '.join(names)} in the condition table")).cast("int"))
        return F.trim(F.get(fields, place - 1))

    names = {name: (name, "path") if name == "fpath" else (name,) for name in schemas.CONDITIONS.names}
    rows = lines.select(*[column(*known).alias(name) for name, known in names.items()], "line_no")
    place = Window.partitionBy("exid").orderBy("line_no")
    return rows.withColumn("cond_order", F.row_number().over(place)).drop("line_no")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """What `write_scores` leaves: chrom, start, end, score, is_outlier, rescaled, exid, bin_tag."""
    rows = spark.read.schema(
        "chrom string, start long, end long, score double, is_outlier boolean, rescaled double, exid string, bin_tag string"
    ).option("sep", "\t").option("header", True).option("enforceSchema", False).csv(path)
    return rows.withColumn("bin_tag", F.regexp_replace("bin_tag", "^rescaled[.]bins_", ""))


def _one_form(path: Column) -> Column:
    """A file's URI with one slash behind the scheme, whatever the number it was written with."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def listed_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """(path as listed, URI of a file): each path is a file, a pattern, or a folder of files. A path without any file is an error."""
    return [(listed, uri) for listed in paths for uri, _ in list_files(spark, listed)]


def read_condition_counts(spark: SparkSession, conditions: DataFrame) -> DataFrame:
    """Site counts of the listed files: `libid, chrom, start, score`, one row per library and site.

    The table may list a library several times, for several experiments, but always with the same path, and no path
    for two libraries. A path may be a folder, such as the `libid=` folders that `write_site_bed` makes. Blocked gzip is read in ranges.
    """
    rows = sorted({(row.libid, row.fpath) for row in conditions.select("libid", "fpath").distinct().collect()})
    for place, name in ((0, "library"), (1, "path")):
        seen = [row[place] for row in rows]
        if twice := sorted({value for value in seen if seen.count(value) > 1}):
            raise ValueError(f"a {name} of the condition table has several entries: {twice}")
    library = {path: libid for libid, path in rows}
    sizes = {path: list_files(spark, path) for _, path in rows}
    files = [(library[path], uri) for path, found in sizes.items() for uri, _ in found]
    if len({uri for _, uri in files}) < len(files):
        raise ValueError("two paths of the condition table hold the same file")
    named = spark.createDataFrame(files, "libid string, uri string").select("libid", _one_form(F.col("uri")).alias("uri"))
    blocked = {uri: size for found in sizes.values() for uri, size in found if blocked_here(uri)}
    others = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString() for _, uri in files if uri not in blocked]
    parts = []
    if others:
        parts.append(read_tsv(spark, others, schemas.BED5).withColumn("uri", F.col("_metadata.file_path")))
    if blocked:
        lines = read_lines(spark, sorted(blocked.items())).filter(F.trim("line") != "")
        fields = F.from_csv("line", ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schemas.BED5), {
            "sep": "\t", "quote": "", "escape": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "mode": "FAILFAST"})
        parts.append(lines.select(F.col("file").alias("uri"), fields.alias("bed")).select("bed.*", "uri"))
    counts = reduce(DataFrame.unionByName, parts).select(
        _one_form(F.col("uri")).alias("uri"), first_token("chrom").alias("chrom"), "start", "score"
    )
    return counts.join(small(named), "uri").groupBy("libid", "chrom", "start").agg(F.sum("score").alias("score"))


def library_files(spark: SparkSession, pattern: str, sep: str = "_") -> DataFrame:
    """Files that match a pattern and the library each belongs to; file contents are not read."""
    return (
        spark.read.format("binaryFile").load(pattern)
        .select("path", library_id("path", sep).alias("libid"))
    )


# Where a run keeps the log of each stage, as folder and text after the library name.
LOG_FILES = {
    "quality": ("fastq_hq", ".log"),
    "prefix": ("fastq_prefix", ".log"),
    "mapping": ("mapping", ".mapping.log"),
    "chrM": ("mapping", ".chrM.txt"),
    "low_mapq": ("mapping", ".lq_count.txt"),
    "clean": ("mapping", ".clean_count.txt"),
    "site": ("atcs", ".clean.umis_at_cs.txt.log"),
    "dedup": ("dedup", ".clean.umis_at_cs.txt.gz.umi_prep_notes.txt"),
}


def numbered_lines(spark: SparkSession, paths: Paths, **options) -> DataFrame:
    """path, line_no (from 0), line: files are read in splits, and a line's number is its place in its split plus the lines of
    the splits before it."""
    rows = spark.read.options(**options).text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )
    splits = rows.groupBy("path", "block", "part").agg(F.min("row").alias("first"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.select(
        "path", "block", "part", (F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first")).alias("base"))
    return rows.join(small(placed), ["path", "block", "part"]).select("path", (F.col("row") + F.col("base")).alias("line_no"), "line")


def read_logs(spark: SparkSession, root: str) -> DataFrame:
    """Lines of all stage logs and count files below `root`: `libid, stage, line_no, line`. A log of any size is read in splits."""
    folders = ",".join(sorted({folder for folder, _ in LOG_FILES.values()}))
    files = numbered_lines(spark, f"{root.rstrip('/')}/{{{folders}}}/*", pathGlobFilter="*.{log,txt}")
    stage, libid = F.lit(None).cast("string"), F.lit(None).cast("string")
    name = base_name("path")
    for key, (folder, suffix) in LOG_FILES.items():
        here = F.col("path").rlike(f"/{folder}/[^/]*$") & name.endswith(suffix)
        stage = F.when(here, key).otherwise(stage)
        libid = F.when(here, F.expr(f"left(substring_index(path, '/', -1), length(substring_index(path, '/', -1)) - {len(suffix)})")).otherwise(libid)
    return files.filter(stage.isNotNull()).select(libid.alias("libid"), stage.alias("stage"), "line_no", "line")
