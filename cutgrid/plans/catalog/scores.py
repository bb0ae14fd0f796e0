"""Rates and scores over ordered conditions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from cutgrid.functions.sizing import stage
from cutgrid.operators import bins as bn, scores as sc
from cutgrid.params import BinTag, ScoreParams, parse_chrom_tag
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.genome import _binned_sql
from cutgrid.plans.catalog.registry import query, rounded, rounded_sql
from cutgrid.plans.score import score

TAGS = [BinTag(1_000, 1_000), BinTag(10_000, 1_000)]
_COUNTS, _CONDS = d.CONDITION_COUNTS_SQL, d.CONDITIONS_SQL
_DEPTH_LIMIT = NormalDist().inv_cdf(1 - 0.01 / 2) ** 2

_WITH_END = """sized AS (SELECT *, start + CASE bin_tag WHEN '1000_1000' THEN 1000 ELSE 10000 END AS "end" FROM binned)"""


def _rates_sql(by_chrom: bool) -> str:
    keys = "libid, chrom" if by_chrom else "libid"
    return f"""{_COUNTS}, {_CONDS}, {_binned_sql(TAGS)}, {_WITH_END},
totals AS (SELECT {keys}, CAST(sum(score) AS BIGINT) AS total_reads FROM site_counts GROUP BY {keys}),
rates AS (SELECT exid, cond_order, s.*, reads / (sites * total_reads) AS rate
          FROM sized s JOIN totals USING ({keys}) JOIN conditions USING (libid))"""


def _scores_sql(by_chrom: bool = False) -> str:
    return f"""{_rates_sql(by_chrom)},
weakest AS (SELECT *, first_value(rate) OVER (PARTITION BY exid, bin_tag, chrom, start ORDER BY cond_order) AS rate_1 FROM rates),
scores AS (
  SELECT exid, bin_tag, chrom, start, "end", sum(CASE WHEN cond_order > 1 THEN log2(rate / rate_1) END) AS score
  FROM weakest GROUP BY exid, bin_tag, chrom, start, "end" HAVING count(*) = 3)"""


def _fenced_sql(by_chrom: bool) -> str:
    keys = "exid, bin_tag, chrom" if by_chrom else "exid, bin_tag"
    return f"""fences AS (
  SELECT {keys}, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.75) AS q3 FROM scores WHERE score IS NOT NULL GROUP BY {keys}),
fenced AS (
  SELECT s.*, coalesce(score < q1 - 1.5 * (q3 - q1) - 1e-9 OR score > q3 + 1.5 * (q3 - q1) + 1e-9, FALSE) AS is_outlier
  FROM scores s LEFT JOIN fences USING ({keys})),
limits AS (SELECT {keys}, min(score) AS lo, max(score) AS hi FROM fenced WHERE NOT is_outlier GROUP BY {keys}),
final AS (
  SELECT f.*, CASE WHEN NOT is_outlier AND hi - lo > 1e-9 THEN (score - lo) / (hi - lo) END AS rescaled
  FROM fenced f LEFT JOIN limits USING ({keys}))"""


SHOWN_SQL = f"""SELECT exid, bin_tag, chrom, start, "end", {rounded_sql("score")} AS score, is_outlier, {rounded_sql("rescaled")} AS rescaled FROM final"""


def _rescaled_sql(by_chrom: bool) -> str:
    return f"{_fenced_sql(by_chrom)}\n{SHOWN_SQL}"


def rates(spark, sf_dir, by_chrom=False):
    counts = d.condition_counts(spark, sf_dir)
    size = F.when(F.col("bin_tag") == "1000_1000", 1_000).otherwise(10_000)
    binned = bn.count_in_bins(counts, TAGS).withColumn("end", F.col("start") + size)
    totals = bn.library_totals(counts, ["libid", "chrom"] if by_chrom else ["libid"])
    rated = sc.bin_rates(binned, totals, "chr" if by_chrom else "lib")
    return bn.with_conditions(rated, d.conditions(spark, sf_dir))


def scored(spark, sf_dir, by_chrom=False):
    return sc.bin_scores(rates(spark, sf_dir, by_chrom), d.conditions(spark, sf_dir))


def _show(table):
    return table.select(
        *sc.EXP_BIN, rounded("score", "score"), "is_outlier", rounded("rescaled", "rescaled")
    )


@query(f"""WITH {_COUNTS}, {_CONDS}
SELECT exid, cond, cond_order, s.* FROM site_counts s JOIN conditions USING (libid)""")
def condition_counts(spark, sf_dir):
    return bn.with_conditions(d.condition_counts(spark, sf_dir), d.conditions(spark, sf_dir))


@query(f"WITH {_COUNTS} SELECT libid, chrom, CAST(sum(score) AS BIGINT) AS total_reads FROM site_counts GROUP BY libid, chrom")
def library_totals(spark, sf_dir):
    return bn.library_totals(d.condition_counts(spark, sf_dir), ["libid", "chrom"])


@query(f"""WITH {_COUNTS},
stats AS (SELECT libid, avg(score) AS mean, var_samp(score) AS var FROM site_counts GROUP BY libid)
SELECT s.*, (score - mean) ** 2 / var > {_DEPTH_LIMIT!r} AS is_outlier FROM site_counts s JOIN stats USING (libid)""")
def bed_outliers(spark, sf_dir):
    return sc.bed_outliers(d.condition_counts(spark, sf_dir))


@query(f"WITH {_rates_sql(False)} SELECT libid, bin_tag, chrom, start, reads, sites, round(rate * 1e6, 6) AS rate FROM rates")
def bin_rates(spark, sf_dir):
    return rates(spark, sf_dir).select(
        "libid", "bin_tag", "chrom", "start", "reads", "sites", rounded(F.col("rate") * 1e6, "rate")
    )


@query(f"WITH {_rates_sql(True)} SELECT libid, bin_tag, chrom, start, reads, sites, round(rate * 1e6, 6) AS rate FROM rates")
def bin_rates_by_chrom(spark, sf_dir):
    return rates(spark, sf_dir, True).select(
        "libid", "bin_tag", "chrom", "start", "reads", "sites", rounded(F.col("rate") * 1e6, "rate")
    )


@query(f"""WITH {_COUNTS}, {d.SITES_SQL}, {_binned_sql(TAGS)},
domain AS (
  SELECT '1000_1000' AS bin_tag, chrom, start // 1000 * 1000 AS start FROM sites
  UNION ALL SELECT '10000_1000', chrom, unnest(range(greatest(0, start // 1000 - 9), start // 1000 + 1)) * 1000 FROM sites),
domain_bins AS (
  SELECT CASE bin_tag WHEN '10000_1000' THEN '1e+04_1000' ELSE bin_tag END AS bin_tag, chrom, start, CAST(count(*) AS BIGINT) AS sites
  FROM domain GROUP BY ALL),
totals AS (SELECT libid, CAST(sum(score) AS BIGINT) AS total_reads FROM site_counts GROUP BY libid)
SELECT t.libid, u.bin_tag, u.chrom, u.start, coalesce(reads, 0) AS reads, u.sites,
       round(coalesce(reads, 0) / (u.sites * total_reads) * 1e6, 6) AS rate
FROM domain_bins u CROSS JOIN totals t
LEFT JOIN binned b ON b.bin_tag = u.bin_tag AND b.chrom = u.chrom AND b.start = u.start AND b.libid = t.libid""")
def universe_rates(spark, sf_dir):
    """Rates over all sites of the genome instead of the sites that have reads; bins without reads have rate 0."""
    counts = d.condition_counts(spark, sf_dir)
    domain = bn.count_in_bins(d.sites(spark, sf_dir), TAGS, (), reads=None)
    binned = sc.universe_bins(bn.count_in_bins(counts, TAGS), domain, d.conditions(spark, sf_dir))
    return sc.bin_rates(binned, bn.library_totals(counts)).select(
        "libid", "bin_tag", "chrom", "start", "reads", "sites", rounded(F.col("rate") * 1e6, "rate")
    )


@query(f"""WITH {_scores_sql()} SELECT exid, bin_tag, chrom, start, "end", {rounded_sql("score")} AS score FROM scores""")
def bin_scores(spark, sf_dir):
    return scored(spark, sf_dir).select(*sc.EXP_BIN, rounded("score", "score"))


@query(f"""WITH {_scores_sql()},
q AS (SELECT exid, bin_tag, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.75) AS q3 FROM scores GROUP BY exid, bin_tag)
SELECT exid, bin_tag, {rounded_sql("q1")} AS q1, {rounded_sql("q3")} AS q3, {rounded_sql("q1 - 1.5 * (q3 - q1)")} AS low,
       {rounded_sql("q3 + 1.5 * (q3 - q1)")} AS high FROM q""")
def score_fences(spark, sf_dir):
    fences = sc.score_fences(scored(spark, sf_dir))
    return fences.select("exid", "bin_tag", *[rounded(c, c) for c in ("q1", "q3", "low", "high")])


@query(f"WITH {_scores_sql()}, {_rescaled_sql(False)}")
def rescaled_scores(spark, sf_dir):
    return _show(sc.rescale_scores(stage(scored(spark, sf_dir))))


@query(f"WITH {_scores_sql(True)}, {_rescaled_sql(True)}")
def rescaled_by_chrom(spark, sf_dir):
    return _show(sc.rescale_scores(stage(scored(spark, sf_dir, True)), normalize_by="chr"))


_RUN = ScoreParams(bin_tags="1e3:1e3,1e4:1e3", chromosome_wide=True, chrom_tag="3:X,Y")


@query(f"""WITH {d.SITES_SQL}, {d.SIZES_SQL}, {d.MASK_SQL}, {_CONDS}, {_COUNTS.replace("site_counts AS", "all_counts AS", 1)},
stats AS (SELECT libid, avg(score) AS mean, var_samp(score) AS var FROM all_counts WHERE chrom IN ('chr1', 'chr2', 'chr3') GROUP BY libid),
site_counts AS (
  SELECT c.* FROM all_counts c JOIN stats USING (libid)
  WHERE chrom IN ('chr1', 'chr2', 'chr3') AND NOT (score - mean) ** 2 / var > {_DEPTH_LIMIT!r}),
tags AS (SELECT '1000_1000' AS bin_tag, 1000 AS size UNION ALL SELECT '1e+04_1000', 10000),
all_bins AS (SELECT bin_tag, chrom, size, "end" AS "length", unnest(range(0, "end", 1000)) AS start FROM sizes, tags),
clipped AS (SELECT bin_tag, chrom, start, least(start + size, "length") AS "end" FROM all_bins),
bins AS (
  SELECT * FROM clipped b
  WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.chrom = b.chrom AND b.start < m."end" AND b."end" > m.start)
  UNION ALL SELECT 'chromosome', chrom, 0, "end" FROM sizes),
{_binned_sql(TAGS).replace("binned AS", "sliding AS")},
binned AS (
  SELECT * FROM sliding UNION ALL
  SELECT libid, 'chromosome', chrom, 0, CAST(sum(score) AS BIGINT), CAST(count(*) AS BIGINT) FROM site_counts GROUP BY libid, chrom),
totals AS (SELECT libid, sum(score) AS total_reads FROM site_counts GROUP BY libid),
rates AS (
  SELECT exid, cond_order, b.bin_tag, b.chrom, b.start, g."end", reads / (sites * total_reads) AS rate
  FROM binned b JOIN bins g ON g.bin_tag = b.bin_tag AND g.chrom = b.chrom AND g.start = b.start
  JOIN totals t ON t.libid = b.libid JOIN conditions c ON c.libid = b.libid),
weakest AS (SELECT *, first_value(rate) OVER (PARTITION BY exid, bin_tag, chrom, start ORDER BY cond_order) AS rate_1 FROM rates),
scores AS (
  SELECT exid, bin_tag, chrom, start, "end", sum(CASE WHEN cond_order > 1 THEN log2(rate / rate_1) END) AS score
  FROM weakest GROUP BY exid, bin_tag, chrom, start, "end" HAVING count(*) = 3),
{_rescaled_sql(False)}""")
def run_scores(spark, sf_dir):
    """The whole score stage: outlier sites and masked bins removed, three resolutions, rescaled."""
    return _show(score(
        d.condition_counts(spark, sf_dir), d.conditions(spark, sf_dir), d.chrom_sizes(spark, sf_dir), _RUN,
        mask=d.mask(spark, sf_dir),
    ))


_TWO_SQL = _CONDS.replace("conditions AS", "one_experiment AS", 1) + """,
conditions AS (
  SELECT exid, libid, cond, CAST(cond_order AS INTEGER) AS cond_order FROM one_experiment
  UNION ALL SELECT 'EXP2', libid, cond, CAST(cond_order - 1 AS INTEGER) FROM one_experiment WHERE cond_order > 1)"""


def two_experiments(spark, sf_dir):
    """The libraries of the experiment, and the two stronger ones as an experiment of their own."""
    one = d.conditions(spark, sf_dir)
    more = one.filter("cond_order > 1").withColumn("exid", F.lit("EXP2")).withColumn("cond_order", F.col("cond_order") - 1)
    return one.unionByName(more)


_ALL_COUNTS = _COUNTS.replace("site_counts AS", "all_counts AS", 1)


def run_steps_sql(params: ScoreParams, custom: bool = False, conditions: str = _CONDS, counts: str = f"{d.SITES_SQL}, {_ALL_COUNTS}") -> str:
    """The score stage stated from scratch: every bin meets its points by a range join. `counts` makes `sites` and `all_counts`."""
    kept = ", ".join(f"'{name}'" for name in parse_chrom_tag(params.chrom_tag))
    tags = " UNION ALL ".join(f"SELECT '{t.label}' AS bin_tag, {t.size} AS size, {t.step} AS step" for t in params.tags)
    masked = """NOT EXISTS (SELECT 1 FROM mask m WHERE m.chrom = b.chrom AND b.start < m."end" AND b."end" > m.start)"""
    if custom:
        own = """SELECT 'custom' AS bin_tag, chrom, region_start AS start, region_end AS "end", region_end AS reach FROM regions"""
    else:
        own = f"""SELECT bin_tag, chrom, start, least(start + size, "length") AS "end", start + size AS reach
          FROM (SELECT bin_tag, chrom, size, "end" AS "length", unnest(range(0, "end", step)) AS start FROM sizes, ({tags}) AS t)"""
    universe = params.site_domain == "universe"
    rate = "CAST(reads AS DOUBLE) / (sites * total_reads)"
    logs = "CASE WHEN rate > 0 AND rate_1 > 0 THEN log2(rate / rate_1) END"
    return f"""{counts}, {d.SIZES_SQL}, {d.MASK_SQL}, {d.REGIONS_SQL}, {conditions},
stats AS (SELECT libid, avg(score) AS mean, var_samp(score) AS var FROM all_counts WHERE chrom IN ({kept}) GROUP BY libid),
points AS (
  SELECT c.* FROM all_counts c JOIN stats USING (libid) WHERE chrom IN ({kept}) AND NOT (score - mean) ** 2 / var > {_DEPTH_LIMIT!r}),
own_bins AS ({own}),
bins AS (
  SELECT * FROM own_bins b WHERE chrom IN ({kept}) AND {masked}
  UNION ALL SELECT 'chromosome', chrom, 0, "end", 1000000000000 FROM sizes WHERE {params.chromosome_wide} AND chrom IN ({kept})),
seen AS (
  SELECT libid, bin_tag, b.chrom, b.start, b."end", sum(score) AS reads, count(*) AS sites
  FROM bins b JOIN points p ON p.chrom = b.chrom AND p.start >= b.start AND p.start < b.reach GROUP BY ALL),
domain AS (
  SELECT bin_tag, b.chrom, b.start, b."end", count(*) AS sites
  FROM bins b JOIN (SELECT DISTINCT chrom, start FROM sites) p ON p.chrom = b.chrom AND p.start >= b.start AND p.start < b.reach GROUP BY ALL),
binned AS ({"""SELECT libid, g.bin_tag, g.chrom, g.start, g."end", coalesce(reads, 0) AS reads, g.sites
  FROM domain g CROSS JOIN (SELECT DISTINCT libid FROM conditions) l
  LEFT JOIN seen s USING (libid, bin_tag, chrom, start, "end")""" if universe else "SELECT * FROM seen"}),
totals AS (SELECT libid, sum(score) AS total_reads FROM points GROUP BY libid),
rates AS (
  SELECT exid, cond_order, b.bin_tag, b.chrom, b.start, b."end", {rate} AS rate
  FROM binned b JOIN totals t ON t.libid = b.libid JOIN conditions c ON c.libid = b.libid),
weakest AS (SELECT *, first_value(rate) OVER (PARTITION BY exid, bin_tag, chrom, start, "end" ORDER BY cond_order) AS rate_1 FROM rates),
scores AS (
  SELECT exid, bin_tag, chrom, start, "end", CASE WHEN min(rate) > 0 THEN sum(CASE WHEN cond_order > 1 THEN {logs} END) END AS score
  FROM weakest GROUP BY exid, bin_tag, chrom, start, "end"
  HAVING count(*) = (SELECT count(*) FROM conditions c WHERE c.exid = weakest.exid)),
{_fenced_sql(False)}"""


def _run_sql(params: ScoreParams, custom: bool = False, conditions: str = _CONDS) -> str:
    return f"{run_steps_sql(params, custom, conditions)}\n{SHOWN_SQL}"


_FIVE = "1e5:1e5,1e5:1e4,5e4:5e3,2e4:2e3,1e4:1e4"
_UNIVERSE = ScoreParams(bin_tags=_FIVE, chromosome_wide=True, site_domain="universe", chrom_tag="22:X,Y")
_REGIONS = ScoreParams(chromosome_wide=True, chrom_tag="22:X,Y")
_REGIONS_UNIVERSE = ScoreParams(chromosome_wide=True, site_domain="universe", chrom_tag="22:X,Y")
_TWO = ScoreParams(bin_tags="1e4:1e4,1e4:1e3", chrom_tag="3:X,Y")


@query(f"WITH {_run_sql(_UNIVERSE)}")
def run_scores_universe(spark, sf_dir):
    """All sites as domain, five resolutions, whole chromosomes, a mask: bins without reads stay, without a score."""
    return _show(score(
        d.condition_counts(spark, sf_dir), d.conditions(spark, sf_dir), d.chrom_sizes(spark, sf_dir), _UNIVERSE,
        sites=d.sites(spark, sf_dir), mask=d.mask(spark, sf_dir),
    ))


@query(f"WITH {_run_sql(_REGIONS, True)}")
def run_scores_regions(spark, sf_dir):
    """Custom bins under a mask, with whole chromosomes."""
    return _show(score(
        d.condition_counts(spark, sf_dir), d.conditions(spark, sf_dir), d.chrom_sizes(spark, sf_dir), _REGIONS,
        mask=d.mask(spark, sf_dir), regions=d.regions(spark, sf_dir),
    ))


@query(f"WITH {_run_sql(_REGIONS_UNIVERSE, True)}")
def run_scores_regions_universe(spark, sf_dir):
    """Custom bins over all sites of the genome."""
    return _show(score(
        d.condition_counts(spark, sf_dir), d.conditions(spark, sf_dir), d.chrom_sizes(spark, sf_dir), _REGIONS_UNIVERSE,
        sites=d.sites(spark, sf_dir), mask=d.mask(spark, sf_dir), regions=d.regions(spark, sf_dir),
    ))


@query(f"WITH {_run_sql(_TWO, conditions=_TWO_SQL)}")
def run_scores_two_experiments(spark, sf_dir):
    """Two libraries serve two experiments: the scores of one do not depend on the other."""
    return _show(score(
        d.condition_counts(spark, sf_dir), two_experiments(spark, sf_dir), d.chrom_sizes(spark, sf_dir), _TWO,
        mask=d.mask(spark, sf_dir),
    ))


@query(f"""WITH {_CONDS},
s AS (SELECT *, CAST(regexp_extract(cond, '^([0-9.]+)', 1) AS DOUBLE) * CASE WHEN cond LIKE '%min' THEN 60.0 ELSE 1.0 END AS seconds FROM conditions)
SELECT *, coalesce(seconds > lag(seconds) OVER (PARTITION BY exid ORDER BY cond_order), TRUE) AS rises FROM s""")
def condition_order(spark, sf_dir):
    return sc.condition_order(d.conditions(spark, sf_dir))
