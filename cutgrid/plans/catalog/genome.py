"""Sequence, bins and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cutgrid.operators import bins as bn, motif as mo
from cutgrid.operators.intervals import intervals_outside_mask, merge_intervals, outside_mask
from cutgrid.params import BinTag, parse_bin_tags, parse_chrom_tag
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.registry import query

MOTIF = "en"
TAGS = parse_bin_tags("1e4:1e3,2e3:2e3,1500:1e3")

_HITS_SQL = f"""starts AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, unnest(range(0, length(text) - {len(MOTIF) - 1})) AS start, text FROM documents),
hits AS (SELECT chrom, start, start + {len(MOTIF)} AS "end" FROM starts
         WHERE lower(substr(text, start + 1, {len(MOTIF)})) = '{MOTIF}')"""


@query(f"WITH {_HITS_SQL} SELECT * FROM hits")
def motif_sites(spark, sf_dir):
    return mo.find_motif(d.contigs(spark, sf_dir), MOTIF)


@query(f"""WITH {_HITS_SQL}
SELECT *, 'site_' || CAST(row_number() OVER (ORDER BY chrom, start) AS VARCHAR) AS name FROM hits""")
def named_sites(spark, sf_dir):
    return mo.name_sites(mo.find_motif(d.contigs(spark, sf_dir), MOTIF))


def _bins_sql(clip: bool) -> str:
    tables = [
        f"SELECT '{t.label}' AS bin_tag, {t.size} AS size, {t.step} AS step" for t in TAGS
    ]
    end = 'least(start + size, "length")' if clip else "start + size"
    return f"""tags AS ({" UNION ALL ".join(tables)}),
all_starts AS (SELECT bin_tag, size, chrom, "end" AS "length", unnest(range(0, "end", step)) AS start FROM sizes, tags),
bins AS (SELECT bin_tag, chrom, start, {end} AS "end" FROM all_starts)"""


@query(f"WITH {d.SITES_SQL}, {d.SIZES_SQL}, {_bins_sql(True)} SELECT * FROM bins")
def bin_table(spark, sf_dir):
    return bn.make_bins(d.chrom_sizes(spark, sf_dir), TAGS)


@query(f"WITH {d.SITES_SQL}, {d.SIZES_SQL}, {_bins_sql(False)} SELECT * FROM bins")
def elongated_bins(spark, sf_dir):
    return bn.make_bins(d.chrom_sizes(spark, sf_dir), TAGS, elongate=True)


_COUNTS = d.CONDITION_COUNTS_SQL


def _binned_sql(tags: list[BinTag]) -> str:
    """Counts in all sliding bins: a bin starts at a multiple of its step, not below 0."""
    parts = [
        f"""SELECT libid, '{t.label}' AS bin_tag, chrom, score,
  unnest(range(greatest(0, CAST(floor((start - {t.size}) / {t.step}) AS BIGINT) + 1), start // {t.step} + 1)) * {t.step} AS start
  FROM site_counts""" for t in tags
    ]
    return f"""pairs AS ({" UNION ALL ".join(parts)}),
binned AS (SELECT libid, bin_tag, chrom, start, CAST(sum(score) AS BIGINT) AS reads, CAST(count(*) AS BIGINT) AS sites
           FROM pairs GROUP BY libid, bin_tag, chrom, start)"""


@query(f"WITH {_COUNTS}, {_binned_sql(TAGS)} SELECT * FROM binned")
def sliding_bins(spark, sf_dir):
    return bn.count_in_bins(d.condition_counts(spark, sf_dir), TAGS)


@query(f"""WITH {_COUNTS}
SELECT libid, 'chromosome' AS bin_tag, chrom, CAST(0 AS BIGINT) AS start, CAST(sum(score) AS BIGINT) AS reads, CAST(count(*) AS BIGINT) AS sites
FROM site_counts GROUP BY libid, chrom""")
def chromosome_bins(spark, sf_dir):
    return bn.count_in_bins(d.condition_counts(spark, sf_dir), [], chromosome_wide=True)


@query(f"""WITH {_COUNTS}, {d.REGIONS_SQL}
SELECT s.libid, r.chrom, region_start, region_end, CAST(sum(s.score) AS BIGINT) AS reads, CAST(count(*) AS BIGINT) AS sites
FROM regions r JOIN site_counts s ON s.chrom = r.chrom AND s.start >= region_start AND s.start < region_end GROUP BY ALL""")
def custom_bins(spark, sf_dir):
    return bn.count_in_regions(d.condition_counts(spark, sf_dir), d.regions(spark, sf_dir))


@query(f"""WITH {d.MASK_SQL},
m AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM mask),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT chrom, min(start) AS start, max("end") AS "end" FROM i GROUP BY chrom, island""")
def mask_merge(spark, sf_dir):
    return merge_intervals(d.mask(spark, sf_dir))


@query(f"""WITH {d.SITES_SQL}, {d.MASK_SQL}
SELECT chrom, start FROM sites s
WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.chrom = s.chrom AND s.start >= m.start AND s.start < m."end")""")
def masked_sites(spark, sf_dir):
    return outside_mask(d.sites(spark, sf_dir), d.mask(spark, sf_dir))


@query(f"""WITH {d.SITES_SQL}, {d.SIZES_SQL}, {_bins_sql(True)}, {d.MASK_SQL}
SELECT * FROM bins b
WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.chrom = b.chrom AND b.start < m."end" AND b."end" > m.start)""")
def masked_bins(spark, sf_dir):
    bins = bn.make_bins(d.chrom_sizes(spark, sf_dir), TAGS)
    return intervals_outside_mask(bins, d.mask(spark, sf_dir)).select("bin_tag", "chrom", "start", "end")


@query(f"""WITH {d.SITES_SQL}, {_COUNTS},
libs AS (SELECT unnest(['A', 'N', 'R']) AS libid)
SELECT libs.libid, s.chrom, s.start, CAST(coalesce(c.score, 0) AS BIGINT) AS score
FROM sites s CROSS JOIN libs LEFT JOIN site_counts c ON c.libid = libs.libid AND c.chrom = s.chrom AND c.start = s.start""")
def universe_sites(spark, sf_dir):
    return bn.universe_sites(d.condition_counts(spark, sf_dir), d.sites(spark, sf_dir), d.conditions(spark, sf_dir))


@query(f"WITH {d.SITES_SQL} SELECT chrom, start FROM sites WHERE chrom IN ('chr1', 'chr2', 'chr4')")
def chrom_filter(spark, sf_dir):
    return bn.keep_chroms(d.sites(spark, sf_dir), parse_chrom_tag("2:4,Y")).select("chrom", F.col("start"))
