"""Per-library summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cutgrid.functions.sizing import stage
from cutgrid.operators import logs as lg, reads as rd, summary as sm, umis as um
from cutgrid.operators.alignments import alignment_counts, umi_from_name
from cutgrid.params import LibraryParams
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.reads import FLAGGED_SQL
from cutgrid.plans.catalog.registry import query, rounded, rounded_sql
from cutgrid.plans.catalog.umis import shifted
from cutgrid.plans.preprocess import flag_reads, preprocess

_STAGED = """staged AS (
  SELECT *, CASE WHEN line LIKE '%flag_extract%' THEN 'quality' ELSE 'mapping' END AS stage FROM log_lines),
matched AS (
  SELECT libid, line_no, CASE WHEN stage = 'quality' THEN line END AS q, CASE WHEN line LIKE '%aligned 0 times' THEN line END AS u FROM staged),
found AS (
  SELECT libid, arg_max(q, line_no) FILTER (q IS NOT NULL) AS q, arg_max(u, line_no) FILTER (u IS NOT NULL) AS u FROM matched GROUP BY libid)"""


def staged_lines(spark, sf_dir):
    return d.log_lines(spark, sf_dir).withColumn(
        "stage", F.when(F.col("line").contains("flag_extract"), "quality").otherwise("mapping")
    )


@query(f"""WITH {d.LOG_LINES_SQL}, {_STAGED}
SELECT libid, CAST(regexp_extract(q, '.* ([0-9]+)/([0-9]+) ', 1) AS BIGINT) AS umi_hq,
       CAST(regexp_extract(q, '.* ([0-9]+)/([0-9]+) ', 2) AS BIGINT) AS input,
       regexp_extract(q, '\\(([0-9.%]+)\\)', 1) AS "umi_hq%",
       CAST(regexp_extract(u, '.* ([0-9]+) \\(', 1) AS BIGINT) AS unmapped FROM found""")
def log_metrics(spark, sf_dir):
    found = lg.log_metrics(staged_lines(spark, sf_dir))
    return found.select("libid", "umi_hq", "input", F.col("`umi_hq%`"), "unmapped")


@query(f"""WITH {d.LOG_LINES_SQL}
SELECT libid, metric FROM (SELECT DISTINCT libid FROM log_lines),
  (SELECT unnest(['prefix', 'prefix%', '2nd_aln', 'chrM', 'low_mapq', 'mapped', 'fromCS', 'fromCS%', 'uniq']) AS metric)""")
def missing_metrics(spark, sf_dir):
    return lg.missing_metrics(lg.log_metrics(staged_lines(spark, sf_dir)))


_TOTALS_SQL = """r AS (SELECT libid, count(*) AS input, count(*) FILTER (good) AS umi_hq, count(*) FILTER (good AND prefix_ok) AS prefix FROM judged GROUP BY libid),
a AS (
  SELECT libid, count(*) FILTER ((flag & 4) <> 0) AS unmapped, count(*) FILTER (mapq < 30) AS low_mapq,
         count(*) FILTER (chrom = 'chrM') AS mito, count(*) FILTER (mapq >= 30 AND (flag & 260) = 0 AND chrom <> 'chrM') AS mapped,
         count(*) FILTER (multi) AS multi FROM alignments GROUP BY libid),
s AS (SELECT libid, count(*) AS n_umis, count(*) FILTER (NOT is_orphan) AS near FROM assigned GROUP BY libid),
u AS (SELECT libid, CAST(sum(counts) AS BIGINT) AS uniq FROM counts GROUP BY libid),
summary AS (
  SELECT 'RUN1' AS prep_run, libid AS library_id, input, umi_hq, umi_hq * 100.0 / input AS "umi_hq%", prefix, prefix * 100.0 / umi_hq AS "prefix%",
         unmapped, multi AS "2nd_aln", mito AS "chrM", low_mapq, mapped, mapped * 100.0 / prefix AS "mapped%",
         near AS "fromCS", near * 100.0 / n_umis AS "fromCS%", uniq, uniq * 100.0 / near AS "uniq%", uniq * 100.0 / input AS "out%"
  FROM r JOIN a USING (libid) JOIN s USING (libid) JOIN u USING (libid))"""
_PLACED_SQL = f"{d.SITES_SQL},\n{d.NEAREST_SQL},\n{d.UNIQUE_SQL}"
_SUMMARY_SQL = f"{FLAGGED_SQL},\n{d.ALIGNED_SQL},\n{d.SHIFTED_SQL},\n{_PLACED_SQL},\n{_TOTALS_SQL}"
_RATIOS = list(sm.RATIOS)


def summary_table(spark, sf_dir):
    placed = stage(um.place_reads(shifted(spark, sf_dir), d.sites(spark, sf_dir)))
    config = d.config(spark, sf_dir)
    stages = [
        sm.read_counts(flag_reads(d.raw_reads(spark, sf_dir), config)),
        alignment_counts(d.alignments(spark, sf_dir)),
        sm.site_totals(um.assign_stats(placed), um.counts_per_site(placed)),
    ]
    return sm.summarize(stages, "RUN1", config)


@query(f"""WITH {_SUMMARY_SQL} SELECT * REPLACE ({", ".join(f'{rounded_sql(chr(34) + c + chr(34))} AS "{c}"' for c in _RATIOS)}) FROM summary""")
def library_summary(spark, sf_dir):
    table = summary_table(spark, sf_dir)
    return table.select(*[rounded(F.col(f"`{c}`"), c) if c in _RATIOS else F.col(f"`{c}`") for c in table.columns])


@query(f"""WITH {_SUMMARY_SQL} SELECT * REPLACE ({", ".join(f"printf('%.2f%%', {chr(34)}{c}{chr(34)}) AS {chr(34)}{c}{chr(34)}" for c in _RATIOS)}) FROM summary ORDER BY library_id""")
def summary_text(spark, sf_dir):
    return sm.as_text(summary_table(spark, sf_dir))


_CLEAN_SQL = """clean AS (
  SELECT a.libid, a.chrom, a.umi, CASE WHEN a.flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, a.pos - 1 AS start,
         r.l_linenumber + 30 + CASE WHEN r.l_partkey % 2 <> 0 THEN r.l_partkey % 3 + 1 ELSE 0 END AS span
  FROM alignments a JOIN reads_raw r USING (read_id) WHERE a.mapq >= 30 AND (a.flag & 260) = 0 AND a.chrom <> 'chrM'),
reads AS (SELECT libid, chrom, umi, CASE WHEN strand = '-' THEN start + span ELSE start - 4 END AS pos FROM clean)"""
RUN_COUNTS_SQL = f"{FLAGGED_SQL},\n{d.ALIGNED_SQL},\n{_CLEAN_SQL},\n{_PLACED_SQL}"
_RUN_SQL = f"{RUN_COUNTS_SQL},\n{_TOTALS_SQL}"


@query(f"""WITH {_RUN_SQL} SELECT * REPLACE ({", ".join(f'{rounded_sql(chr(34) + c + chr(34))} AS "{c}"' for c in _RATIOS)}) FROM summary""")
def run_summary(spark, sf_dir):
    """The whole preprocessing stage: reads and alignments in, site counts out of the clean alignments, one summary."""
    _, table = preprocess(
        d.raw_reads(spark, sf_dir), d.alignments(spark, sf_dir), d.config(spark, sf_dir), d.sites(spark, sf_dir), "RUN1"
    )
    return table.select(*[rounded(F.col(f"`{c}`"), c) if c in _RATIOS else F.col(f"`{c}`") for c in table.columns])


SIX = LibraryParams(cut_seq="AAGCTT", pattern="umi8bc8cs6")


def six_letter_reads(spark, sf_dir):
    return d.raw_reads(spark, sf_dir).select(
        "libid", "read_id", F.concat(F.substring("seq", 1, 16), F.lit("AAGCT"), F.substring("seq", 20, 1), F.expr("substring(seq, 21)")).alias("seq"),
        F.concat(F.lit("A~"), F.substring("qual", 3, 14), F.lit("~~"), F.expr("substring(qual, 17)")).alias("qual"),
    )


@query(f"""WITH {d.RAW_READS_SQL},
six AS (
  SELECT libid, read_id, substr(seq, 1, 16) || 'AAGCT' || substr(seq, 20, 1) || substr(seq, 21) AS seq, 'A~' || substr(qual, 3, 14) || '~~' || substr(qual, 17) AS qual FROM raw_reads)
SELECT libid, read_id, substr(seq, 1, 8) AS umi, substr(qual, 1, 8) AS umi_qual,
       hamming(substr(seq, 9, 8), '{d.BARCODE}') <= 1 AND hamming(substr(seq, 17, 6), 'AAGCTT') <= 1 AS prefix_ok FROM six""")
def six_letter_run(spark, sf_dir):
    """A six-letter enzyme: flags cut by its pattern, put into the names and taken out again; qualities hold the sign between flags."""
    reads = six_letter_reads(spark, sf_dir)
    flagged = flag_reads(reads, d.config(spark, sf_dir), SIX)
    named = flagged.select("libid", "prefix_ok", F.col("read_id").alias("id"), rd.flagged_name(SIX.pattern).alias("read_id"))
    return umi_from_name(named).select("libid", F.col("id").alias("read_id"), "umi", "umi_qual", "prefix_ok")
