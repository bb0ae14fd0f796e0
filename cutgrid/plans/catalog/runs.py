"""Whole runs on files, and the files that runs exchange: one ordered file per library, blocked gzip, contigs on one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import fresh_dir
from cutgrid.operators import bins as bn, motif as mo, summary as sm, umis as um
from cutgrid.params import ScoreParams, parse_chrom_tag
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.files import _ASCII_SQL
from cutgrid.plans.catalog.genome import MOTIF
from cutgrid.plans.catalog.registry import query
from cutgrid.plans.catalog.scores import SHOWN_SQL, _show, run_steps_sql
from cutgrid.plans.catalog.summary import RUN_COUNTS_SQL, SIX, _TOTALS_SQL, six_letter_reads
from cutgrid.plans.preprocess import cut_sites, finish_run
from cutgrid.plans.run import run
from cutgrid.sources import sinks, tables as tb
from cutgrid.sources.fasta import read_fasta
from cutgrid.sources.fastq import read_fastq
from cutgrid.sources.ordered import write_ordered


@query(f"WITH {d.RAW_READS_SQL} SELECT libid, read_id, seq, qual FROM raw_reads")
def fastq_blocked_scan(spark, sf_dir):
    """One blocked gzip file per library, each read in ranges by several tasks."""
    out = fresh_dir(spark, "fastq-blocked")
    sinks.write_reads(d.raw_reads(spark, sf_dir), out, whole=True, level=1)
    return read_fastq(spark, out, range_bytes=1 << 16).select("libid", "read_id", "seq", "qual")


@query(f"""WITH {_ASCII_SQL},
starts AS (SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, unnest(range(0, length(text) - 1)) AS start, text FROM documents_ascii)
SELECT chrom, start, start + 2 AS "end" FROM starts WHERE lower(substr(text, start + 1, 2)) = '{MOTIF}'""")
def one_line_fasta_sites(spark, sf_dir):
    """Contigs on one line each, read in ranges that begin and end anywhere in them."""
    out = fresh_dir(spark, "fasta-lines")
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", "N"))
    record = F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" dna\n"), letters)
    d.table(spark, sf_dir, "documents").select(record.alias("value")).write.text(out)
    return mo.find_motif(read_fasta(spark, out, range_bytes=10_007), MOTIF)


def _condition_table(spark, sf_dir, out: str, conditions: DataFrame, bed: str) -> str:
    """A condition table that lists the file `<bed>/<library>.bed.gz` of each library; its path."""
    lines = conditions.select(
        "exid", "cond", "libid", F.concat(F.lit(f"{bed}/"), "libid", F.lit(".bed.gz")).alias("fpath"), "cond_order")
    sinks.write_tsv(lines.coalesce(1).sortWithinPartitions("exid", "cond_order").drop("cond_order"), f"{out}/meta", compress=False, header=True)
    return f"{out}/meta"


@query(f"""WITH {d.CONDITION_COUNTS_SQL}, {d.CONDITIONS_SQL}
SELECT exid, cond, cond_order, libid, chrom, start, score FROM site_counts JOIN conditions USING (libid)""")
def bed_files_scan(spark, sf_dir):
    """One BED file per library, in order, listed by path in a condition table."""
    out = fresh_dir(spark, "bed files")
    counts = d.condition_counts(spark, sf_dir).select("libid", "chrom", F.col("start").alias("site"), F.col("score").alias("counts"))
    sinks.write_site_bed(um.site_bed(counts), f"{out}/bed", whole=True)
    conditions = tb.read_conditions(spark, _condition_table(spark, sf_dir, out, d.conditions(spark, sf_dir), f"{out}/bed"))
    return bn.with_conditions(tb.read_condition_counts(spark, conditions), conditions)


def _flagged_read() -> Column:
    """A read name as the aligner hands it back."""
    return F.concat("read_id", F.lit("~~umi~"), "umi", F.lit("~~qumi~"), "umi_qual")


def _write_sam(alignments: DataFrame, path: str) -> None:
    """One file `<library>.sam.gz` of blocked gzip each."""
    line = F.concat_ws(
        "\t", _flagged_read(), F.col("flag").cast("string"), "chrom", F.col("pos").cast("string"),
        F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"),
        F.when(F.col("multi"), "AS:i:0\tXS:i:-5").otherwise("AS:i:0"),
    )
    pieces = alignments.select("libid", "read_id", F.lit(True).alias("opens"), line.alias("text"))
    write_ordered(pieces, path, ["read_id"], "{libid}.sam")


_COUNTED = [c for c in sm.SUMMARY_COLUMNS if c not in ("prep_run", "library_id")]
_RUN = ScoreParams(bin_tags="1e4:1e4,1e4:1e3", chromosome_wide=True, chrom_tag="22:X,Y", site_domain="universe")


def _values_sql() -> str:
    """Summary and scores of a run as named numbers."""
    summary = ", ".join(
        f"""('{c}', CAST({f"rtrim(printf('%.2f%%', {chr(34)}{c}{chr(34)}), '%')" if c in sm.RATIOS else f'"{c}"'} AS DOUBLE))""" for c in _COUNTED)
    place = """concat_ws('|', exid, bin_tag, chrom, CAST(start AS VARCHAR), CAST("end" AS VARCHAR))"""
    return f"""
SELECT 'summary' AS part, library_id AS place, name, value FROM summary, LATERAL (SELECT * FROM (VALUES {summary}) AS v(name, value))
UNION ALL SELECT 'scores', {place}, 'score', score FROM shown
UNION ALL SELECT 'scores', {place}, 'rescaled', rescaled FROM shown
UNION ALL SELECT 'scores', {place}, 'is_outlier', CAST(is_outlier AS DOUBLE) FROM shown"""


def _named(rows: DataFrame, part: str, place: Column, values: dict[str, Column]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), value.cast("double").alias("value")) for name, value in values.items()])
    return rows.select(F.lit(part).alias("part"), place.alias("place"), F.inline(pairs))


_RUN_SCORES_SQL = f"""{run_steps_sql(
    _RUN, counts="all_counts AS (SELECT libid, chrom, site AS start, counts AS score FROM counts)")},
shown AS ({SHOWN_SQL})"""


@query(f"WITH {RUN_COUNTS_SQL},\n{_TOTALS_SQL},\n{_RUN_SCORES_SQL}{_values_sql()}")
def whole_run(spark, sf_dir):
    """FASTQ, alignments, configuration and condition table in; counts, summary and scores out, read from the run's files."""
    out = fresh_dir(spark, "whole-run")
    sinks.write_reads(d.raw_reads(spark, sf_dir), f"{out}/fastq", whole=True)
    sinks.write_tsv(d.config(spark, sf_dir).select("libid", "barcode"), f"{out}/config")
    _write_sam(d.alignments(spark, sf_dir), f"{out}/mapping")
    names = F.concat("chrom", F.lit("_"), F.col("start").cast("string"))
    sinks.write_tsv(d.sites(spark, sf_dir).select("chrom", "start", F.col("start") + 4, names), f"{out}/sites")
    sinks.write_tsv(d.chrom_sizes(spark, sf_dir).select("chrom", "start", "end"), f"{out}/sizes")
    sinks.write_tsv(d.mask(spark, sf_dir).select("chrom", "start", "end", F.lit("m").alias("name")), f"{out}/mask")
    meta = _condition_table(spark, sf_dir, out, d.conditions(spark, sf_dir), f"{out}/run/bed")
    inputs = {"config": f"{out}/config", "fastq": f"{out}/fastq"}
    run(spark, f"{out}/run", **inputs)  # until the aligner has to run
    done = run(
        spark, f"{out}/run", **inputs, sam=f"{out}/mapping", sites=f"{out}/sites", conditions=meta, sizes=f"{out}/sizes",
        mask=f"{out}/mask", score_params=_RUN,
    )
    table = spark.read.option("sep", "\t").option("header", True).csv(done.paths["summary_table"])
    summary = _named(table, "summary", F.col("library_id"), {c: F.rtrim(F.col(f"`{c}`"), F.lit("%")) for c in _COUNTED})
    place = F.concat_ws("|", "exid", "bin_tag", "chrom", F.col("start").cast("string"), F.col("end").cast("string"))
    scores = _named(_show(done.tables["scores"]), "scores", place, {
        "score": F.col("score"), "rescaled": F.col("rescaled"), "is_outlier": F.col("is_outlier").cast("int"),
    })
    return summary.unionByName(scores)


#: Names of the contigs of the made-up mouse: numbers, and letters for three of them.
_LETTERED = {20: "X", 21: "Y", 22: "M"}
_KEPT = ", ".join(f"'{name}'" for name in parse_chrom_tag("19:X,Y"))


def _contig(number: Column) -> Column:
    name = number.cast("string")
    for place, letter in _LETTERED.items():
        name = F.when(number == place, letter).otherwise(name)
    return name


def _contig_sql(number: str) -> str:
    cases = " ".join(f"WHEN {place} THEN '{letter}'" for place, letter in _LETTERED.items())
    return f"CASE {number} {cases} ELSE CAST({number} AS VARCHAR) END"


_MOUSE_SQL = f"""{d._RAW_SQL},
genome AS (
  SELECT 'chr' || {_contig_sql("doc_id")} AS chrom,
         regexp_replace(replace(upper(regexp_replace(text, '[^A-Za-z]', 'N', 'g')), 'EN', '{SIX.cut_seq}'), '[^ACGT]', 'N', 'g') AS text FROM documents),
spots AS (SELECT chrom, unnest(range(0, length(text) - 5)) AS start, text FROM genome),
sites AS (SELECT chrom, start FROM spots WHERE substr(text, start + 1, 6) = '{SIX.cut_seq}'),
{d.ALIGNED_SQL},
clean AS (
  SELECT a.libid, 'chr' || {_contig_sql("r.l_suppkey % 30")} AS chrom, a.umi, CASE WHEN a.flag & 16 <> 0 THEN '-' ELSE '+' END AS strand,
         r.l_orderkey % 5000 + r.l_linenumber * 3 AS start,
         r.l_linenumber + 30 + CASE WHEN r.l_partkey % 2 <> 0 THEN r.l_partkey % 3 + 1 ELSE 0 END AS span
  FROM alignments a JOIN reads_raw r USING (read_id) WHERE a.mapq >= 30 AND (a.flag & 260) = 0),
reads AS (SELECT libid, chrom, umi, CASE WHEN strand = '-' THEN start + span ELSE start - 6 END AS pos FROM clean WHERE chrom <> 'chrM'),
{d.NEAREST_SQL},
{d.UNIQUE_SQL},
bed AS (
  SELECT libid, chrom, site AS start, site AS "end", 'pos_' || CAST(row_number() OVER (PARTITION BY libid ORDER BY chrom, site) AS VARCHAR) AS name,
         counts AS score FROM counts)"""


@query(f"WITH {_MOUSE_SQL} SELECT * FROM bed WHERE chrom IN ({_KEPT})")
def mouse_run(spark, sf_dir):
    """A genome searched for a six-letter site, reads of that enzyme counted on the sites found, and the BED kept for `19:X,Y`."""
    out = fresh_dir(spark, "mouse")
    letters = F.replace(F.upper(F.regexp_replace("text", "[^A-Za-z]", "N")), F.lit("EN"), F.lit(SIX.cut_seq))
    sequence = F.regexp_replace(F.regexp_replace(letters, "[^ACGT]", "N"), "(.{70})", "$1\n")
    record = F.concat(F.lit(">"), _contig(F.col("doc_id")), F.lit(" dna\n"), sequence)
    d.table(spark, sf_dir, "documents").select(record.alias("value")).write.text(f"{out}/genome")
    found = cut_sites(spark, f"{out}/genome", SIX)
    sinks.write_tsv(found.select("chrom", "start", "end", "name"), f"{out}/sites")
    sinks.write_reads(six_letter_reads(spark, sf_dir), f"{out}/fastq", whole=True)
    sinks.write_tsv(d.config(spark, sf_dir).select("libid", "barcode"), f"{out}/config")
    aligned = d.alignments(spark, sf_dir).withColumns({
        "chrom": F.concat(F.lit("chr"), _contig(F.col("ord.l_suppkey") % 30)),
        "pos": F.col("ord.l_orderkey") % 5000 + F.col("ord.l_linenumber") * 3 + 1,
    })
    _write_sam(aligned, f"{out}/mapping")
    finish_run(spark, f"{out}/config", f"{out}/fastq", f"{out}/mapping", f"{out}/sites", f"{out}/run", "MOUSE", SIX)
    bed = tb.read_bed(spark, f"{out}/run/bed", columns=5).withColumn("libid", tb.file_library())
    return bn.keep_chroms(bed, parse_chrom_tag("19:X,Y")).select("libid", "chrom", "start", "end", "name", "score")
