"""Reads on cut sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cutgrid.operators import umis as um
from cutgrid.operators.intervals import index_sites
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.registry import query, rounded
from cutgrid.sources.sinks import joined


def shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return um.shift_plus(d.reads(spark, sf_dir), len(d.CUT_SEQ))


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return um.assign(shifted(spark, sf_dir), d.sites(spark, sf_dir))


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return um.site_counts(shifted(spark, sf_dir), d.sites(spark, sf_dir))


@query(f"WITH {d.COUNTS_SQL} SELECT * FROM counts")
def site_counts(spark, sf_dir):
    return counted(spark, sf_dir)


@query(f"WITH {d.COUNTS_SQL} SELECT * FROM counts")
def site_counts_shuffled(spark, sf_dir):
    """The same with the site look-up treated as too large for a broadcast."""
    index = index_sites(d.sites(spark, sf_dir), max_bytes=0)
    return um.site_counts(shifted(spark, sf_dir), index)


@query(f"WITH {d.ASSIGNED_SQL} SELECT libid, chrom, pos, strand, umi, site, dist FROM assigned")
def nearest_site(spark, sf_dir):
    return assigned(spark, sf_dir).select("libid", "chrom", "pos", "strand", "umi", "site", "dist")


@query(f"WITH {d.ASSIGNED_SQL} SELECT libid, chrom, site AS pos, umi, qual FROM assigned WHERE is_orphan")
def orphan_reads(spark, sf_dir):
    return um.orphans(assigned(spark, sf_dir))


@query(f"""WITH {d.READS_SQL}, {d.SITES_SQL}
SELECT libid, chrom, CAST(count(*) AS BIGINT) AS n_umis FROM reads
WHERE chrom NOT IN (SELECT chrom FROM sites) GROUP BY libid, chrom""")
def skipped_chroms(spark, sf_dir):
    return um.skipped_chroms(shifted(spark, sf_dir), d.sites(spark, sf_dir))


@query(f"""WITH {d.READS_SQL}, {d.SITES_SQL}
SELECT libid, chrom, pos, strand, umi FROM reads WHERE chrom IN (SELECT chrom FROM sites)""")
def known_chrom_reads(spark, sf_dir):
    return um.known_chroms(shifted(spark, sf_dir), d.sites(spark, sf_dir)).select(
        "libid", "chrom", "pos", "strand", "umi"
    )


@query(f"""WITH {d.READS_SQL}, {d.SITES_SQL}
SELECT DISTINCT chrom, chrom IN (SELECT chrom FROM sites) AS has_sites FROM reads ORDER BY chrom""")
def chrom_list(spark, sf_dir):
    """Sorted chromosomes of the reads and whether the site list knows them."""
    known = d.sites(spark, sf_dir).select("chrom").distinct().withColumn("has_sites", F.lit(True))
    chroms = shifted(spark, sf_dir).select("chrom").distinct()
    return chroms.join(known, "chrom", "left").select(
        "chrom", F.coalesce("has_sites", F.lit(False)).alias("has_sites")
    ).orderBy("chrom")


@query(f"""WITH {d.READS_SQL}
SELECT libid, chrom, pos, CAST(count(*) AS BIGINT) AS n,
       string_agg(umi, ' ' ORDER BY {d.ORDER_SQL}) AS umi, string_agg(qual, ' ' ORDER BY {d.ORDER_SQL}) AS qual
FROM reads GROUP BY libid, chrom, pos""")
def group_positions(spark, sf_dir):
    lists = um.group_positions(shifted(spark, sf_dir))
    return lists.select("libid", "chrom", "pos", "n", joined("umi"), joined("qual"))


HOT_ROWS = 1_000
HOT_SQL = f"""{d.READS_SQL},
hot AS (SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 'chr1' ELSE chrom END AS chrom, CASE WHEN l_partkey % 3 = 0 THEN 77 ELSE pos END AS pos) FROM reads)"""


def hot_reads(spark, sf_dir):
    """Reads of which a third lie on one position."""
    on_hot = F.col("ord.l_partkey") % 3 == 0
    return shifted(spark, sf_dir).withColumn("chrom", F.when(on_hot, "chr1").otherwise(F.col("chrom"))).withColumn(
        "pos", F.when(on_hot, 77).otherwise(F.col("pos"))
    )


@query(f"""WITH {HOT_SQL},
placed AS (SELECT *, (row_number() OVER (PARTITION BY libid, chrom, pos ORDER BY strand, {", ".join(d._KEYS)}) - 1) // {HOT_ROWS} AS chunk,
                  count(*) OVER (PARTITION BY libid, chrom, pos) AS n FROM hot)
SELECT libid, chrom, pos, chunk, n, string_agg(umi, ' ' ORDER BY strand, {", ".join(d._KEYS)}) AS umi FROM placed GROUP BY libid, chrom, pos, chunk, n""")
def hot_position_lists(spark, sf_dir):
    """A position with a third of all reads: its list comes in stretches of exact rank, each with the whole group's size."""
    lists = um.group_positions(hot_reads(spark, sf_dir), max_rows=HOT_ROWS)
    return lists.select("libid", "chrom", "pos", "chunk", "n", joined("umi"))


@query(f"""WITH {d.ASSIGNED_SQL}
SELECT libid, chrom, site, CAST(count(*) AS BIGINT) AS n,
       string_agg(umi, ' ' ORDER BY {d.ORDER_SQL}) AS umi, string_agg(qual, ' ' ORDER BY {d.ORDER_SQL}) AS qual
FROM assigned WHERE NOT is_orphan GROUP BY libid, chrom, site""")
def site_merge(spark, sf_dir):
    lists = um.merge_sites(assigned(spark, sf_dir))
    return lists.select("libid", "chrom", "site", "n", joined("umi"), joined("qual"))


@query(f"""WITH {d.ASSIGNED_SQL},
seen AS (SELECT *, row_number() OVER (PARTITION BY libid, chrom, site ORDER BY {d.ORDER_SQL}) AS place
         FROM assigned WHERE NOT is_orphan),
firsts AS (SELECT libid, chrom, site, umi, min(place) AS place FROM seen GROUP BY libid, chrom, site, umi)
SELECT libid, chrom, site, string_agg(umi, ' ' ORDER BY place) AS umis, CAST(count(*) AS BIGINT) AS counts
FROM firsts GROUP BY libid, chrom, site""")
def dedup_lists(spark, sf_dir):
    return um.dedup_lists(assigned(spark, sf_dir)).select("libid", "chrom", "site", joined("umis"), "counts")


@query(f"""WITH {d.COUNTS_SQL},
t AS (SELECT libid, CAST(sum(pre_n) AS BIGINT) AS reads, CAST(sum(counts) AS BIGINT) AS kept FROM counts GROUP BY libid)
SELECT libid, reads, kept, reads - kept AS removed, round((reads - kept) * 100.0 / reads, 6) AS removed_pct FROM t""")
def dedup_totals(spark, sf_dir):
    totals = um.dedup_totals(counted(spark, sf_dir))
    return totals.select("libid", "reads", "kept", "removed", rounded("removed_pct", "removed_pct"))


_TRIMMED_SQL = """reads AS (
  SELECT libid, umi FROM reads_raw UNION ALL SELECT libid || ':cut', substr(umi, 1, CAST(8 - l_orderkey % 3 AS INTEGER)) FROM reads_raw)"""


@query(f"""WITH {d._RAW_SQL}, {_TRIMMED_SQL},
l AS (SELECT DISTINCT libid, length(umi) AS len FROM reads)
SELECT libid, string_agg(CAST(len AS VARCHAR), ' ' ORDER BY len) AS lengths, CAST(count(*) AS BIGINT) AS n_lengths,
       round(avg(len), 6) AS mean_length FROM l GROUP BY libid""")
def umi_lengths(spark, sf_dir):
    """Whole UMIs, which have one length, and as libraries of their own the same UMIs cut to several."""
    whole = d.reads(spark, sf_dir)
    cut = whole.withColumns({
        "libid": F.concat("libid", F.lit(":cut")),
        "umi": F.substring(F.col("umi"), F.lit(1), (8 - F.col("ord.l_orderkey") % 3).cast("int")),
    })
    return um.umi_lengths(whole.unionByName(cut)).select(
        "libid", F.array_join(F.col("lengths").cast("array<string>"), " ").alias("lengths"), "n_lengths",
        rounded("mean_length", "mean_length"),
    )


@query(f"""WITH {d.ASSIGNED_SQL},
p AS (SELECT libid, chrom, pos, site, dist, is_orphan, count(*) AS n FROM assigned GROUP BY ALL),
t AS (SELECT libid, CAST(sum(n) AS BIGINT) AS n_umis, CAST(count(*) AS BIGINT) AS n_pos, min(dist) AS dist_min,
             avg(dist) AS dist_mean, max(dist) AS dist_max,
             CAST(sum(n) FILTER (NOT is_orphan) AS BIGINT) AS n_clean_umis,
             CAST(count(*) FILTER (NOT is_orphan) AS BIGINT) AS n_clean_pos,
             CAST(count(DISTINCT (chrom, site)) FILTER (NOT is_orphan) AS BIGINT) AS n_sites FROM p GROUP BY libid)
SELECT libid, n_umis, n_pos, dist_min, round(dist_mean, 6) AS dist_mean, dist_max, n_clean_umis, n_clean_pos, n_sites,
       round(n_clean_umis * 100.0 / n_umis, 6) AS clean_umis_pct, round(n_clean_pos * 100.0 / n_pos, 6) AS clean_pos_pct,
       round(n_sites * 100.0 / n_pos, 6) AS sites_pct FROM t""")
def assign_stats(spark, sf_dir):
    stats = um.position_stats(shifted(spark, sf_dir), d.sites(spark, sf_dir))
    doubles = {"dist_mean", "clean_umis_pct", "clean_pos_pct", "sites_pct"}
    return stats.select(*[rounded(c, c) if c in doubles else F.col(c) for c in stats.columns])


@query(f"""WITH {d.COUNTS_SQL}
SELECT libid, chrom, site AS start, site AS "end",
       'pos_' || CAST(row_number() OVER (PARTITION BY libid ORDER BY chrom, site) AS VARCHAR) AS name, counts AS score
FROM counts""")
def site_bed(spark, sf_dir):
    return um.site_bed(counted(spark, sf_dir))


