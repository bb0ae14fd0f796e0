"""Prefix flags and read quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from cutgrid.operators import quality as qu, reads as rd
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.registry import query, rounded
from cutgrid.plans.preprocess import flag_reads

PATTERN = "umi8bc8cs4"

FLAGGED_SQL = f"""{d.RAW_READS_SQL},
flagged AS (
  SELECT libid, read_id, substr(seq, 1, 8) AS umi, substr(qual, 1, 8) AS umi_qual, substr(seq, 9, 8) AS bc,
         substr(qual, 9, 8) AS bc_qual, substr(seq, 17, 4) AS cs, substr(qual, 17, 4) AS cs_qual,
         substr(seq, 21) AS seq, substr(qual, 21) AS qual FROM raw_reads),
judged AS (
  SELECT *, len(list_filter(string_split(umi_qual, ''), lambda c: ascii(c) - 33 < 30)) / 8.0 <= 0.2 AS good,
         hamming(bc, '{d.BARCODE}') <= 1 AND hamming(cs, '{d.CUT_SEQ}') <= 1 AS prefix_ok FROM flagged)"""


def flagged(spark, sf_dir):
    return rd.extract_flags(d.raw_reads(spark, sf_dir), PATTERN)


@query(f"WITH {FLAGGED_SQL} SELECT * FROM flagged")
def flag_extract(spark, sf_dir):
    return flagged(spark, sf_dir).drop("matched")


@query(f"WITH {FLAGGED_SQL} SELECT libid, read_id, umi, umi_qual FROM judged WHERE good")
def quality_filter(spark, sf_dir):
    kept = rd.flag_status(flagged(spark, sf_dir)).filter("status = 'hq'")
    return kept.select("libid", "read_id", "umi", "umi_qual")


@query(f"WITH {FLAGGED_SQL} SELECT libid, read_id, bc, cs, seq FROM judged WHERE good AND prefix_ok")
def prefix_filter(spark, sf_dir):
    kept = flag_reads(d.raw_reads(spark, sf_dir), d.config(spark, sf_dir)).filter("status = 'hq' and prefix_ok")
    return kept.select("libid", "read_id", "bc", "cs", "seq")


@query(f"""WITH {d.RAW_READS_SQL},
cut AS (
  SELECT libid, read_id, seq, qual FROM raw_reads
  UNION ALL SELECT libid, read_id || ':cut', substr(seq, 1, length(seq) - 15), substr(qual, 1, length(seq) - 15) FROM raw_reads)
SELECT libid, read_id, CASE WHEN length(seq) < 20 THEN 'unmatched'
         WHEN len(list_filter(string_split(substr(qual, 1, 8), ''), lambda c: ascii(c) - 33 < 30)) / 8.0 <= 0.2 THEN 'hq'
         ELSE 'lq' END AS status, CASE WHEN length(seq) < 20 THEN seq ELSE substr(seq, 21) END AS seq FROM cut""")
def reject_status(spark, sf_dir):
    """Whole reads, and the same reads cut so that the short ones no longer hold the whole prefix."""
    keep = F.length("seq") - 15
    whole = d.raw_reads(spark, sf_dir).select("libid", "read_id", "seq", "qual")
    cut = whole.select(
        "libid", F.concat("read_id", F.lit(":cut")).alias("read_id"), F.substring("seq", F.lit(1), keep).alias("seq"),
        F.substring("qual", F.lit(1), keep).alias("qual"),
    )
    return rd.flag_status(rd.extract_flags(whole.unionByName(cut), PATTERN)).select("libid", "read_id", "status", "seq")


_STATS_SQL = f"""{FLAGGED_SQL},
vals AS (SELECT libid, 'bc' AS flag, bc AS value FROM flagged UNION ALL SELECT libid, 'cs', cs FROM flagged),
stats AS (SELECT libid, flag, value, CAST(count(*) AS BIGINT) AS n FROM vals GROUP BY ALL)"""


@query(f"""WITH {_STATS_SQL}
SELECT libid, flag, value, n, round(n / sum(n) OVER (PARTITION BY libid, flag), 6) AS share FROM stats""")
def flag_stats(spark, sf_dir):
    stats = rd.flag_stats(flagged(spark, sf_dir))
    return stats.select("libid", "flag", "value", "n", rounded("share", "share"))


@query(f"""WITH {_STATS_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY libid, flag ORDER BY n DESC, value) AS place FROM stats)
SELECT libid, flag, value, n, CASE flag WHEN 'bc' THEN '{d.BARCODE}' ELSE '{d.CUT_SEQ}' END AS expected,
       value = CASE flag WHEN 'bc' THEN '{d.BARCODE}' ELSE '{d.CUT_SEQ}' END AS is_expected
FROM ranked WHERE place = 1""")
def flag_top(spark, sf_dir):
    expected = rd.expected_flags(d.config(spark, sf_dir), d.CUT_SEQ)
    return rd.flag_top(rd.flag_stats(flagged(spark, sf_dir)), expected)


@query(f"""WITH {FLAGGED_SQL}
SELECT libid, read_id || '~~umi~' || umi || '~~bc~' || bc || '~~cs~' || cs || '~~qumi~' || umi_qual
       || '~~qbc~' || bc_qual || '~~qcs~' || cs_qual AS name FROM flagged""")
def flagged_names(spark, sf_dir):
    return flagged(spark, sf_dir).select("libid", rd.flagged_name(PATTERN).alias("name"))


@query(f"""WITH {d.RAW_READS_SQL},
chars AS (SELECT libid, unnest(range(1, length(qual) + 1)) AS pos, qual FROM raw_reads),
h AS (SELECT libid, CAST(pos AS INTEGER) AS pos, ascii(substr(qual, pos, 1)) - 33 AS q, count(*) AS n FROM chars GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY libid, pos ORDER BY q) AS upto, sum(n) OVER (PARTITION BY libid, pos) AS total FROM h)
SELECT libid, pos, CAST(sum(n) AS BIGINT) AS n, round(sum(q * n) / sum(n), 6) AS mean_q,
       min(q) FILTER (upto * 100 >= total * 10) AS p10, min(q) FILTER (upto * 100 >= total * 25) AS q1,
       min(q) FILTER (upto * 100 >= total * 50) AS median, min(q) FILTER (upto * 100 >= total * 75) AS q3,
       min(q) FILTER (upto * 100 >= total * 90) AS p90 FROM r GROUP BY libid, pos""")
def read_qc_by_position(spark, sf_dir):
    profile = qu.quality_by_position(d.raw_reads(spark, sf_dir))
    return profile.withColumn("mean_q", rounded("mean_q", "mean_q"))


@query(f"""WITH {d.RAW_READS_SQL},
chars AS (SELECT libid, unnest(range(1, length(seq) + 1)) AS pos, seq FROM raw_reads),
h AS (SELECT libid, CAST(pos AS INTEGER) AS pos, substr(seq, pos, 1) AS base, CAST(count(*) AS BIGINT) AS n FROM chars GROUP BY ALL)
SELECT *, round(n / sum(n) OVER (PARTITION BY libid, pos), 6) AS share FROM h""")
def base_composition(spark, sf_dir):
    return qu.base_composition(d.raw_reads(spark, sf_dir)).withColumn("share", rounded("share", "share"))


@query(f"""WITH {d.RAW_READS_SQL},
m AS (
  SELECT libid, 'length' AS measure, CAST(length(seq) AS BIGINT) AS value FROM raw_reads
  UNION ALL SELECT libid, 'gc_percent', (length(regexp_replace(seq, '[^GC]', '', 'g')) * 100 + length(seq) // 2) // length(seq) FROM raw_reads
  UNION ALL SELECT libid, 'mean_quality', CAST(list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) AS BIGINT) // length(qual) FROM raw_reads)
SELECT libid, measure, value, CAST(count(*) AS BIGINT) AS n FROM m GROUP BY ALL""")
def read_histograms(spark, sf_dir):
    return qu.read_histograms(d.raw_reads(spark, sf_dir))


@query(f"""WITH {d.RAW_READS_SQL},
s AS (SELECT libid, seq, count(*) AS copies FROM raw_reads GROUP BY ALL)
SELECT libid, CAST(copies AS BIGINT) AS copies, CAST(count(*) AS BIGINT) AS n_sequences, CAST(sum(copies) AS BIGINT) AS n_reads
FROM s GROUP BY libid, copies""")
def duplication_levels(spark, sf_dir):
    return qu.duplication_levels(d.raw_reads(spark, sf_dir))


@query(f"""WITH {d.RAW_READS_SQL},
t AS (SELECT libid, count(*) AS total FROM raw_reads GROUP BY libid),
s AS (SELECT libid, seq, CAST(count(*) AS BIGINT) AS n FROM raw_reads GROUP BY ALL)
SELECT libid, seq, n, round(n * 100.0 / total, 6) AS percent FROM s JOIN t USING (libid) WHERE n > total * 0.0001""")
def overrepresented(spark, sf_dir):
    """With a share low enough to find copies among these reads."""
    return qu.overrepresented(d.raw_reads(spark, sf_dir), 0.0001).withColumn("percent", rounded("percent", "percent"))
