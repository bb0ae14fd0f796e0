"""Nearest sites, running totals, masks and regions against hand-made and brute-force results."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cutgrid.operators import bins as bn
from cutgrid.operators.intervals import (
    index_sites, intervals_outside_mask, merge_intervals, nearest, neighbours, outside_mask, running,
)
from cutgrid.operators.umis import assign

SITES = [("chrA", 100), ("chrA", 200), ("chrA", 300), ("chrB", 50)]
READS = {
    ("chrA", 90): (100, 10, False),
    ("chrA", 150): (100, 50, True),
    ("chrA", 195): (200, 5, False),
    ("chrA", 205): (200, 5, False),
    ("chrA", 200): (200, 0, False),
    ("chrA", 320): (300, 20, False),
    ("chrA", 321): (300, 21, True),
    ("chrB", 40): (50, 10, False),
    ("chrB", 45): (50, 5, False),
}


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_nearest_by_hand(spark, max_bytes):
    sites = spark.createDataFrame(SITES, "chrom string, start long")
    reads = spark.createDataFrame([*READS, ("chrC", 10)], "chrom string, pos long")
    rows = assign(reads, index_sites(sites, max_bytes=max_bytes)).collect()
    assert {(r.chrom, r.pos): (r.site, r.dist, r.is_orphan) for r in rows} == READS


def brute_nearest(sites, point):
    return min(sites, key=lambda s: (abs(s - point), s))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    sites=st.sets(st.integers(0, 40_000_000), min_size=1, max_size=40),
    dense=st.integers(0, 3_000_000), points=st.lists(st.integers(-10, 45_000_000), min_size=1, max_size=60),
)
def test_nearest_is_brute_force(spark, sites, dense, points):
    sites = sorted(sites | set(range(dense, dense + 30)))
    points = points + sites + [s + 1 for s in sites]
    table = spark.createDataFrame([("c", s) for s in sites] * 2, "chrom string, start long")
    reads = spark.createDataFrame([("c", p) for p in points], "chrom string, pos long")
    for limit in (None, 0):
        found = nearest(reads, index_sites(table, max_bytes=limit)).collect()
        assert len(found) == len(points)
        assert all(r.site == brute_nearest(sites, r.pos) and r.dist == abs(r.site - r.pos) for r in found)


def test_a_dense_stretch_makes_no_pairs(spark):
    """A thousand sites four bases apart in one cell: every read still meets one row of the index."""
    dense = spark.range(1_000).select(F.lit("c").alias("chrom"), (F.col("id") * 4).alias("start"))
    sites = dense.union(spark.createDataFrame([("c", 1 << 30)], "chrom string, start long"))
    index = index_sites(sites)
    assert index.cells.groupBy("chrom", "cell").count().filter("count > 1").isEmpty()
    reads = spark.range(5_000).select(F.lit("c").alias("chrom"), F.col("id").alias("pos"))
    placed = nearest(reads, index).collect()
    assert len(placed) == 5_000 and all(r.site == min(3_996, max(0, (r.pos + 1) // 4 * 4)) for r in placed)


def test_nearest_plan_has_no_pairing_and_splits_hot_cells(spark):
    """A third of the reads on one position: the shuffled join is split, nothing else groups raw reads."""
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    try:
        sites = spark.range(0, 20_000, 1, 4).select(
            F.concat(F.lit("c"), F.col("id") % 2).alias("chrom"), (F.col("id") * 97).alias("start")
        )
        reads = spark.range(0, 60_000, 1, 6).select(
            F.when(F.col("id") % 3 == 0, "c1").otherwise(F.concat(F.lit("c"), F.col("id") % 2)).alias("chrom"),
            F.when(F.col("id") % 3 == 0, 777).otherwise(F.col("id") * 31).alias("pos"), F.col("id").alias("tag"),
        )
        placed = nearest(reads, index_sites(sites, max_bytes=0))
        assert placed.select("tag").distinct().count() == 60_000
        placed.write.format("noop").mode("overwrite").save()
        text = placed._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert "NestedLoop" not in text and "Cartesian" not in text
        placed.collect()
        final = placed._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for key in ("skewedPartitionThresholdInBytes", "skewedPartitionFactor"):
            spark.conf.unset(f"spark.sql.adaptive.skewJoin.{key}")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_neighbours_across_blocks(spark):
    sites = [3, 9, (1 << 20) - 1, 1 << 20, 5 << 20, (5 << 20) + 1]
    table = spark.createDataFrame([("c", s) for s in sites], "chrom string, site long")
    got = {r.site: (r.previous, r.next) for r in neighbours(table).collect()}
    want = {s: (a, b) for s, a, b in zip(sites, [None, *sites], [*sites[1:], None])}
    assert got == want


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_crosses_blocks(spark, inclusive):
    rng = random.Random(5)
    rows = [("k", p, rng.randint(-5, 50)) for p in sorted(rng.sample(range(200), 60))]
    table = spark.createDataFrame(rows, "k string, p long, v long")
    both = running(running(table, ["k"], "p", {"s": F.col("v")}, "sum", inclusive, 16), ["k"], "p",
                   {"m": F.col("v")}, "max", inclusive, 16)
    for r in both.collect():
        before = [v for _, p, v in rows if p < r.p or (inclusive and p == r.p)]
        assert r.s == sum(before) and r.m == (max(before) if before else None)


def intervals(rng, n, span, width):
    out = []
    for _ in range(n):
        s = rng.randrange(span)
        out.append((rng.choice(["a", "b"]), s, s + rng.randrange(1, width)))
    return out


def covered(rows, chrom):
    return {p for c, s, e in rows if c == chrom for p in range(s, e)}


def test_merge_and_masks_are_brute_force(spark):
    rng = random.Random(11)
    mask = intervals(rng, 25, 3_000, 120) + [("a", 10, 10)]
    mask_df = spark.createDataFrame(mask, "chrom string, start long, end long")
    merged = [(r.chrom, r.start, r.end) for r in merge_intervals(mask_df).collect()]
    for chrom in "ab":
        assert covered(merged, chrom) == covered(mask, chrom)
        ends = sorted((s, e) for c, s, e in merged if c == chrom)
        assert all(e < s2 for (_, e), (s2, _) in zip(ends, ends[1:]))
    points = [(c, p) for c in "abz" for p in range(0, 3_200, 3)]
    kept = outside_mask(spark.createDataFrame(points, "chrom string, start long"), mask_df).collect()
    assert {(r.chrom, r.start) for r in kept} == {(c, p) for c, p in points if p not in covered(mask, c)}
    spans = intervals(rng, 60, 3_200, 200)
    left = intervals_outside_mask(spark.createDataFrame(spans, "chrom string, start long, end long"), mask_df)
    want = sorted(s for s in spans if not covered([s], s[0]) & covered(mask, s[0]))
    assert sorted((r.chrom, r.start, r.end) for r in left.collect()) == want


def test_region_totals_are_brute_force(spark):
    rng = random.Random(3)
    counts = [(lib, c, rng.randrange(3_000), rng.randint(1, 5)) for lib in "XY" for c in "ab" for _ in range(80)]
    regions = intervals(rng, 40, 3_000, 900)
    got = bn.count_in_regions(
        spark.createDataFrame(counts, "libid string, chrom string, start long, score long"),
        spark.createDataFrame(regions, "chrom string, region_start long, region_end long"),
    ).collect()
    want = {}
    for c, s, e in set(regions):
        for lib in "XY":
            inside = [(p, n) for l2, c2, p, n in counts if (l2, c2) == (lib, c) and s <= p < e]
            if inside:
                want[lib, c, s, e] = (sum(n for _, n in inside), len({p for p, _ in inside}))
    got = {(r.libid, r.chrom, r.region_start, r.region_end): (r.reads, r.sites) for r in got}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(size=st.integers(1, 400), part=st.integers(1, 400), points=st.sets(st.integers(0, 5_000), min_size=1, max_size=50))
def test_bins_are_range_tests(spark, size, part, points):
    from cutgrid.params import BinTag

    tag = BinTag(size, min(part, size))
    table = spark.createDataFrame([("L", "c", p, 2) for p in points], "libid string, chrom string, start long, score long")
    got = {r.start: (r.reads, r.sites) for r in bn.count_in_bins(table, [tag]).collect()}
    want = {}
    for start in range(0, max(points) + 1, tag.step):
        inside = [p for p in points if start <= p < start + size]
        if inside:
            want[start] = (2 * len(inside), len(inside))
    assert got == want


def test_a_bin_as_long_as_a_chromosome_is_one_row(spark):
    """No row per cell: what the plan reads and makes grows with the number of intervals, not with their length."""
    spans = spark.createDataFrame([("chr1", 0, 250_000_000), ("chr1", 0, 100), ("chr2", 0, 240_000_000)], "chrom string, start long, end long")
    mask_df = spark.createDataFrame([("chr1", 121_000_000, 125_000_000), ("chr3", 0, 5)], "chrom string, start long, end long")
    left = intervals_outside_mask(spans, mask_df)
    assert "Generate" not in left._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, left.select("chrom", "start", "end").collect())) == [("chr1", 0, 100), ("chr2", 0, 240_000_000)]
