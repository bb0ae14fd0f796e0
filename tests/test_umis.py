"""Grouping, merging, deduplication, numbering."""

import random

import pytest
from pyspark.sql import functions as F

from cutgrid.operators import umis as um
from cutgrid.operators.intervals import index_sites
from cutgrid.operators.numbering import number_rows

READ = "libid string, chrom string, pos long, strand string, umi string, qual string, ord long"


@pytest.fixture()
def reads(spark):
    rows = [
        ("L1", "chrA", 104, "+", "AC", "q1", 2), ("L1", "chrA", 100, "-", "GT", "q2", 1),
        ("L1", "chrA", 104, "+", "GT", "q3", 1), ("L1", "chrA", 110, "-", "AC", "q4", 3),
        ("L1", "chrA", 160, "-", "TT", "q5", 4), ("L1", "chrC", 5, "-", "TT", "q6", 5),
        ("L2", "chrA", 100, "-", "AC", "q7", 1),
    ]
    return spark.createDataFrame(rows, READ)


@pytest.fixture()
def sites(spark):
    return spark.createDataFrame([("chrA", 100), ("chrA", 220)], "chrom string, start long")


def test_shift_and_group(reads):
    grouped = um.group_positions(um.shift_plus(reads, 4)).collect()
    assert {(r.libid, r.chrom, r.pos): (r.n, r.umi, r.qual) for r in grouped}[("L1", "chrA", 100)] == (
        3, ["GT", "AC", "GT"], ["q3", "q1", "q2"],
    )


def test_merge_dedup_and_orphans(reads, sites):
    placed = um.assign(um.shift_plus(reads, 4), sites)
    merged = {(r.libid, r.site): r.umi for r in um.merge_sites(placed).collect()}
    assert merged == {("L1", 100): ["GT", "AC", "GT", "AC"], ("L2", 100): ["AC"]}
    lists = {(r.libid, r.site): (r.umis, r.counts) for r in um.dedup_lists(placed).collect()}
    assert lists == {("L1", 100): (["GT", "AC"], 2), ("L2", 100): (["AC"], 1)}
    assert [(r.pos, r.umi) for r in um.orphans(placed).collect()] == [(100, "TT")]
    assert [(r.chrom, r.n_umis) for r in um.skipped_chroms(reads, sites).collect()] == [("chrC", 1)]


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_site_counts_and_totals(reads, sites, max_bytes):
    counts = um.site_counts(um.shift_plus(reads, 4), index_sites(sites, max_bytes=max_bytes))
    assert {(r.libid, r.site): (r.pre_n, r.counts) for r in counts.collect()} == {
        ("L1", 100): (4, 2), ("L2", 100): (1, 1),
    }
    totals = {r.libid: (r.reads, r.removed, r.kept, r.removed_pct) for r in um.dedup_totals(counts).collect()}
    assert totals == {"L1": (4, 2, 2, 50.0), "L2": (1, 0, 1, 0.0)}


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_stats_agree_for_reads_and_weights(reads, sites, max_bytes):
    shifted, index = um.shift_plus(reads, 4), index_sites(sites, max_bytes=max_bytes)
    one = um.assign_stats(um.assign(shifted, index)).orderBy("libid").collect()
    two = um.assign_stats(um.place_reads(shifted, index)).orderBy("libid").collect()
    assert one == two
    assert one[0].n_umis == 5 and one[0].n_pos == 3 and one[0].dist_max == 60 and one[0].n_sites == 1


def test_hot_groups_are_split_without_loss(spark):
    """A third of the reads on one position become several rows, in order; other groups stay whole."""
    reads = spark.range(0, 3_000, 1, 4).select(
        F.lit("L").alias("libid"), F.lit("c").alias("chrom"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(100 + F.col("id") % 300).alias("pos"), F.lit("+").alias("strand"),
        F.col("id").cast("string").alias("umi"), F.lit("q").alias("qual"), F.col("id").alias("ord"),
    )
    rows = um.group_positions(reads, max_rows=200).collect()
    hot = sorted((r for r in rows if r.pos == 7), key=lambda r: r.chunk)
    assert [r.chunk for r in hot] == list(range(5)) and {r.n for r in hot} == {1_000} and {len(r.umi) for r in hot} == {200}
    assert [int(u) for r in hot for u in r.umi] == list(range(0, 3_000, 3))
    cold = [r for r in rows if r.pos != 7]
    assert len(cold) == len({r.pos for r in cold}) and sum(len(r.umi) for r in rows) == 3_000
    assert {r.chunk for r in cold} == {0}


def test_umi_lengths(spark):
    reads = spark.createDataFrame([("L", "AC"), ("L", "ACG"), ("L", "GG"), ("M", "A")], "libid string, umi string")
    rows = {r.libid: (r.lengths, r.mean_length) for r in um.umi_lengths(reads).collect()}
    assert rows == {"L": ([2, 3], 2.5), "M": ([1], 1.0)}


def test_numbers_run_over_the_sorted_table(spark):
    rows = [(lib, chrom, pos) for lib in "xy" for chrom in ("chr1", "chr10", "chr2") for pos in range(0, 500, 7)]
    table = spark.createDataFrame(rows, "libid string, chrom string, start long").repartition(5)
    for by in ([], ["libid"]):
        numbered = number_rows(table.dropDuplicates([*by, "chrom", "start"]), "n", by, width=64).collect()
        groups = {}
        for r in numbered:
            groups.setdefault(tuple(r[b] for b in by), []).append((r.chrom, r.start, r.n))
        for group in groups.values():
            assert [n for *_, n in sorted(group)] == list(range(1, len(group) + 1))


def test_deduplication_is_idempotent(reads, sites):
    placed = um.assign(um.shift_plus(reads, 4), sites)
    once = um.unique_umis(placed)
    again = once.select("libid", "chrom", "site", "umi", F.lit(False).alias("is_orphan"), F.lit(1).alias("n"))
    assert um.counts_per_site(again).agg(F.sum("counts")).first()[0] == once.count()


def test_site_bed_numbers(reads, sites):
    bed = um.site_bed(um.site_counts(reads, sites)).orderBy("libid", "start").collect()
    assert [(r.libid, r.start, r.end, r.name, r.score) for r in bed] == [
        ("L1", 100, 100, "pos_1", 2), ("L2", 100, 100, "pos_1", 1),
    ]


def test_position_stats_look_up_positions_and_not_reads(spark):
    """The same totals as from assigned reads, but what meets the site index is one row per position."""
    rng = random.Random(3)
    reads = spark.createDataFrame(
        [("A" if i % 3 else "B", "chr1", rng.choice([5, 5, 5, 90, 400, 411, 700]), "+", f"U{i % 7}") for i in range(500)],
        "libid string, chrom string, pos long, strand string, umi string")
    sites = spark.createDataFrame([("chr1", 0), ("chr1", 400), ("chr1", 650)], "chrom string, start long")
    direct = um.position_stats(reads, sites)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, um.assign_stats(um.assign(reads, sites)).collect()))
    plan = direct._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("count(1) AS n#"):]
    assert "Join" in plan[:plan.index("count(1) AS n#")] and "Join" not in below.split("LogicalRDD")[0]
