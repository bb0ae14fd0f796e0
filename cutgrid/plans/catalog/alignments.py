"""Alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from cutgrid.operators import alignments as aln, reads as rd
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.reads import FLAGGED_SQL, PATTERN, flagged
from cutgrid.plans.catalog.registry import query

CLEAN = "mapq >= 30 AND (flag & 260) = 0 AND chrom <> 'chrM'"
SPAN = "list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), lambda n: CAST(n AS BIGINT)))"


@query(f"WITH {d.ALIGNMENTS_SQL} SELECT libid, read_id, flag, chrom, pos, mapq FROM alignments WHERE {CLEAN}")
def alignment_filter(spark, sf_dir):
    clean = aln.filter_alignments(d.alignments(spark, sf_dir))
    return clean.select("libid", "read_id", "flag", "chrom", "pos", "mapq")


@query(f"""WITH {d.ALIGNMENTS_SQL}
SELECT libid, CAST(count(*) FILTER ((flag & 4) <> 0) AS BIGINT) AS unmapped,
       CAST(count(*) FILTER (mapq < 30) AS BIGINT) AS low_mapq, CAST(count(*) FILTER (chrom = 'chrM') AS BIGINT) AS "chrM",
       CAST(count(*) FILTER ({CLEAN}) AS BIGINT) AS mapped, CAST(count(*) FILTER (multi) AS BIGINT) AS "2nd_aln"
FROM alignments GROUP BY libid""")
def alignment_counts(spark, sf_dir):
    return aln.alignment_counts(d.alignments(spark, sf_dir))


@query(f"""WITH {d.ALIGNMENTS_SQL}
SELECT libid, read_id, CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END AS strand, pos - 1 AS start,
       CAST(pos - 1 + {SPAN} AS BIGINT) AS "end" FROM alignments""")
def alignment_intervals(spark, sf_dir):
    return aln.to_intervals(d.alignments(spark, sf_dir)).select("libid", "read_id", "strand", "start", "end")


@query(f"""WITH {d.ALIGNMENTS_SQL}
SELECT libid, chrom, CAST(CASE WHEN (flag & 16) <> 0 THEN pos - 1 + {SPAN} ELSE pos - 1 END AS BIGINT) AS pos,
       CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END AS strand, umi, umi_qual AS qual
FROM alignments WHERE {CLEAN}""")
def alignment_position(spark, sf_dir):
    return aln.positioned_umis(aln.filter_alignments(d.alignments(spark, sf_dir))).drop("ord")


_PAIRED_SQL = f"""{d.ALIGNMENTS_SQL},
paired AS (
  SELECT libid, read_id, chrom, flag + CASE WHEN mapq % 3 <> 0 THEN 1 ELSE 0 END + CASE WHEN mapq % 5 = 0 THEN 8 ELSE 0 END AS flag,
         CASE mapq % 4 WHEN 0 THEN '=' WHEN 1 THEN '*' WHEN 2 THEN 'chr1' ELSE 'chr2' END AS rnext FROM alignments)"""


@query(f"""WITH {_PAIRED_SQL}
SELECT libid, read_id, chrom, rnext FROM paired
WHERE (flag & 1) <> 0 AND (flag & 12) = 0 AND rnext NOT IN ('=', '*') AND rnext <> chrom""")
def chimeric_reads(spark, sf_dir):
    mapq = F.col("mapq")
    paired = d.alignments(spark, sf_dir).select(
        "libid", "read_id", "chrom",
        (F.col("flag") + F.when(mapq % 3 != 0, 1).otherwise(0) + F.when(mapq % 5 == 0, 8).otherwise(0)).alias("flag"),
        F.when(mapq % 4 == 0, "=").when(mapq % 4 == 1, "*").when(mapq % 4 == 2, "chr1").otherwise("chr2").alias("rnext"),
    )
    return paired.filter(aln.is_chimeric()).select("libid", "read_id", "chrom", "rnext")


@query(f"WITH {FLAGGED_SQL} SELECT libid, umi, umi_qual FROM flagged")
def umi_from_name(spark, sf_dir):
    """UMIs written into read names and taken out of them again."""
    named = flagged(spark, sf_dir).select("libid", rd.flagged_name(PATTERN).alias("read_id"))
    return aln.umi_from_name(named).select("libid", "umi", "umi_qual")
