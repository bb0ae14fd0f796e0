"""Parameters, rates, scores, and the two whole stages."""

import math

import pytest
from pyspark.sql import functions as F

from cutgrid import params as pr
from cutgrid.operators import bins as bn, scores as sc
from cutgrid.plans import preprocess as pp
from cutgrid.plans.score import score
from cutgrid.sources import sinks, tables as tb


def test_parameter_texts():
    assert [(f.name, f.start, f.width) for f in pr.parse_pattern("umi8bc8cs6")] == [("umi", 1, 8), ("bc", 9, 8), ("cs", 17, 6)]
    tags = pr.parse_bin_tags("1e6:1e5,5e4:5e4,25e3:25e3")
    assert [(t.size, t.step) for t in tags] == [(1_000_000, 100_000), (50_000, 50_000), (25_000, 25_000)]
    assert tags[0].label == "1e+06_1e+05" and pr.BinTag(100_000, 10_000).label == "1e+05_1e+04"
    assert pr.parse_chrom_tag("2:X,Y") == ["chr1", "chr2", "chrX", "chrY"]
    assert pr.parse_outlier_tag("iqr:1.5", ["iqr"]) == ("iqr", 1.5)
    for bad in (lambda: pr.parse_pattern("8umi"), lambda: pr.parse_bin_tags("1e5:1e6"), lambda: pr.parse_bin_tags("1.5:1"),
                lambda: pr.ScoreParams(site_domain="all"), lambda: pr.parse_outlier_tag("x:1", ["iqr"])):
        with pytest.raises(ValueError):
            bad()


COUNTS = "libid string, chrom string, start long, score long"
CONDITIONS = "exid string, cond string, cond_order int, libid string"


@pytest.fixture()
def experiment(spark):
    counts = spark.createDataFrame(
        [("A", "chr1", 5, 4), ("A", "chr1", 15, 4), ("B", "chr1", 5, 2), ("B", "chr1", 7, 2), ("B", "chr1", 15, 4), ("B", "chr2", 1, 8)],
        COUNTS,
    )
    return counts, spark.createDataFrame([("E", "1min", 1, "A"), ("E", "5min", 2, "B")], CONDITIONS)


def test_scores_by_hand(experiment):
    counts, conditions = experiment
    binned = bn.count_in_bins(counts, [pr.BinTag(10, 10)]).withColumn("end", F.col("start") + 10)
    rates = bn.with_conditions(sc.bin_rates(binned, bn.library_totals(counts)), conditions)
    got = {r.start: r.score for r in sc.bin_scores(rates, conditions).collect()}
    first = math.log2((4 / (2 * 16)) / (4 / (1 * 8)))
    second = math.log2((4 / 16) / (4 / 8))
    assert set(got) == {0, 10} and got[0] == pytest.approx(first) and got[10] == pytest.approx(second)


def test_universe_keeps_bins_without_reads(spark, experiment):
    counts, conditions = experiment
    sites = spark.createDataFrame([("chr1", 5), ("chr1", 7), ("chr1", 15), ("chr1", 25), ("chr2", 1)], "chrom string, start long")
    tags = [pr.BinTag(10, 10)]
    domain = bn.count_in_bins(sites, tags, (), reads=None).withColumn("end", F.col("start") + 10)
    binned = sc.universe_bins(bn.count_in_bins(counts, tags), domain, conditions)
    rates = bn.with_conditions(sc.bin_rates(binned, bn.library_totals(counts)), conditions)
    got = {(r.chrom, r.start): r.score for r in sc.bin_scores(rates, conditions, "universe").collect()}
    assert set(got) == {("chr1", 0), ("chr1", 10), ("chr1", 20), ("chr2", 0)}
    assert got[("chr1", 20)] is None and got[("chr2", 0)] is None
    assert got[("chr1", 0)] == pytest.approx(math.log2((4 / (2 * 16)) / (4 / (2 * 8))))


def test_normalising_by_chromosome(experiment):
    counts, _ = experiment
    totals = {(r.libid, r.chrom): r.total_reads for r in bn.library_totals(counts, ["libid", "chrom"]).collect()}
    assert totals == {("A", "chr1"): 8, ("B", "chr1"): 8, ("B", "chr2"): 8}
    binned = bn.count_in_bins(counts, [], chromosome_wide=True)
    rates = sc.bin_rates(binned, bn.library_totals(counts, ["libid", "chrom"]), "chr").collect()
    assert {(r.libid, r.chrom): r.rate for r in rates} == {("A", "chr1"): 0.5, ("B", "chr1"): 1 / 3, ("B", "chr2"): 1.0}


def test_depth_outliers(spark):
    rows = [("A", "chr1", i, 10 + i % 3) for i in range(50)] + [("A", "chr1", 99, 500), ("B", "chr1", 1, 7)]
    flagged = sc.bed_outliers(spark.createDataFrame(rows, COUNTS)).filter("is_outlier").collect()
    assert [(r.libid, r.start) for r in flagged] == [("A", 99)]


def test_rescaling_keeps_outliers_flagged(spark):
    rows = [("E", "t", "chr1", i, i + 1, float(i)) for i in range(10)] + [("E", "t", "chr1", 50, 51, 900.0), ("E", "t", "chr1", 60, 61, None)]
    table = spark.createDataFrame(rows, "exid string, bin_tag string, chrom string, start long, end long, score double")
    got = {r.start: (r.is_outlier, r.rescaled) for r in sc.rescale_scores(table).collect()}
    assert got[50] == (True, None) and got[60][1] is None
    assert got[0] == (False, 0.0) and got[9] == (False, 1.0) and got[3][1] == pytest.approx(1 / 3)


def test_equal_scores_are_not_rescaled(spark):
    rows = [("E", "t", "chr1", i, i + 1, 0.1 + 0.2 if i % 5 else 0.3) for i in range(20)]
    table = spark.createDataFrame(rows, "exid string, bin_tag string, chrom string, start long, end long, score double")
    assert {(r.is_outlier, r.rescaled) for r in sc.rescale_scores(table).collect()} == {(False, None)}


def test_condition_order_is_checked(spark):
    rows = [("E", "20s", 1, "A"), ("E", "5min", 2, "B"), ("E", "1min", 3, "C")]
    got = {r.cond: r.rises for r in sc.condition_order(spark.createDataFrame(rows, CONDITIONS)).collect()}
    assert got == {"20s": True, "5min": True, "1min": False}


def test_universe_fills_zeros(spark, experiment):
    sites = spark.createDataFrame([("chr1", 5), ("chr1", 7), ("chr9", 1)], "chrom string, start long")
    got = {(r.libid, r.chrom, r.start): r.score for r in bn.universe_sites(experiment[0], sites, experiment[1]).collect()}
    assert got == {("A", "chr1", 5): 4, ("B", "chr1", 5): 2, ("A", "chr1", 7): 0, ("B", "chr1", 7): 2, ("A", "chr9", 1): 0, ("B", "chr9", 1): 0}


@pytest.mark.parametrize("domain", ["separate", "universe"])
def test_score_stage(spark, tmp_path, domain):
    counts = spark.range(600).select(
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("id") % 3 + 1).cast("int")).alias("libid"),
        F.when(F.col("id") % 4 == 0, "chr2").otherwise("chr1").alias("chrom"), F.expr("id * 10 div 3 * 3").alias("start"),
        (F.col("id") * 7 % 5 + 1).alias("score"),
    )
    conditions = spark.createDataFrame([("E", f"{i}min", i, lib) for i, lib in enumerate("ABC", 1)], CONDITIONS)
    sizes = spark.createDataFrame([("chr1", 0, 6_100), ("chr2", 0, 6_100)], "chrom string, start long, end long")
    mask = spark.createDataFrame([("chr1", 0, 900), ("chr1", 500, 1_000)], "chrom string, start long, end long")
    params = pr.ScoreParams(bin_tags="2e3:5e2,1e3:1e3", chromosome_wide=True, site_domain=domain, chrom_tag="2:X,Y")
    table = score(counts, conditions, sizes, params, sites=counts.select("chrom", "start"), mask=mask)
    rows = table.collect()
    assert {r.bin_tag for r in rows} == {"2000_500", "1000_1000", "chromosome"}
    assert all(r.start >= 1_000 for r in rows if r.chrom == "chr1" and r.bin_tag != "chromosome")
    assert all(r.rescaled is None or 0 <= r.rescaled <= 1 for r in rows)
    sinks.write_scores(table, str(tmp_path / "scores"))
    assert {p.name for p in (tmp_path / "scores" / "exid=E").iterdir()} == {
        f"bin_tag=rescaled.bins_{t}" for t in ("2000_500", "1000_1000", "chromosome")
    }
    regions = spark.createDataFrame([("chr1", 0, 3_000), ("chr1", 0, 6_000), ("chr2", 100, 5_000)], "chrom string, region_start long, region_end long")
    sites = counts.select("chrom", "start")
    assert score(counts, conditions, sizes, params, sites=sites, regions=regions).groupBy("bin_tag").count().orderBy("bin_tag").collect() == [
        ("chromosome", 2), ("custom", 3)
    ]
    masked = score(counts, conditions, sizes, params, sites=sites, mask=mask, regions=regions).filter("bin_tag = 'custom'").collect()
    assert [(r.chrom, r.start, r.end) for r in masked] == [("chr2", 100, 5_000)]


def test_library_from_files_to_bed(spark, tmp_path):
    """FASTQ, genome and SAM files in; site list, reads to align, BED and summary out."""
    genome = "TTTT" + "GATC" + "A" * 92 + "gatc" + "C" * 96 + "GATC" + "T" * 50
    (tmp_path / "genome.fa").write_text(f">1 dna\n{genome}\n")
    sites = pp.cut_sites(spark, str(tmp_path / "genome.fa")).orderBy("start")
    assert [(r.chrom, r.start, r.end, r.name) for r in sites.collect()] == [
        ("chr1", 4, 8, "site_1"), ("chr1", 100, 104, "site_2"), ("chr1", 200, 204, "site_3"),
    ]
    sinks.write_tsv(sites, str(tmp_path / "sites"))
    (tmp_path / "run.config").write_text("K1\tCATCACGC\n")
    (tmp_path / "fastq").mkdir()
    umis = ["AAAAAAAA", "AAAAAAAA", "CCCCCCCC", "GGGGGGGG"]
    reads = [f"@r{i}\n{u}CATCACGCGATC{'ACGT' * 5}\n+\n{'I' * 40}\n" for i, u in enumerate(umis)]
    reads.append(f"@bad\n{'A' * 8}CATCACGCGATC{'ACGT' * 5}\n+\n{'!' * 40}\n")
    reads.append(f"@alien\n{'A' * 8}GGGGGGGGGATC{'ACGT' * 5}\n+\n{'I' * 40}\n")
    (tmp_path / "fastq" / "K1_S1_R1.fastq").write_text("".join(reads))
    out = tmp_path / "out"
    pp.prepare_run(spark, str(tmp_path / "run.config"), str(tmp_path / "fastq"), str(out))
    ready = [r.value for r in spark.read.text(f"{out}/fastq_prefix").collect() if r.value.startswith("@r")]
    assert len(ready) == 4
    rejected = {r.status: r["count"] for r in spark.read.text(f"{out}/fastq_rejected").filter("value = '+'").groupBy("status").count().collect()}
    assert rejected == {"lq": 1, "prefix_unmatched": 1}

    names = sorted(line[1:] for line in ready)
    places = [(0, 105), (0, 105), (0, 105), (16, 81)]
    sam = ["@HD\tVN:1.0"] + [f"{n}\t{f}\tchr1\t{p}\t42\t20M\t*\t0\t0\t*\t*\tAS:i:0" for n, (f, p) in zip(names, places)]
    (tmp_path / "sam").mkdir()
    (tmp_path / "sam" / "K1.sam").write_text("\n".join(sam) + "\n")
    pp.finish_run(
        spark, str(tmp_path / "run.config"), str(tmp_path / "fastq"), str(tmp_path / "sam"), str(tmp_path / "sites"),
        str(out), "RUN9",
    )
    bed = tb.read_bed(spark, f"{out}/bed", columns=5).collect()
    assert [(r.chrom, r.start, r.end, r.name, r.score) for r in bed] == [("chr1", 100, 100, "pos_1", 3)]
    header, line = next((out / "summary_table").glob("part-*")).read_text().splitlines()
    row = dict(zip(header.split("\t"), line.split("\t")))
    assert (row["prep_run"], row["library_id"], row["input"], row["umi_hq"], row["prefix"]) == ("RUN9", "K1", "6", "5", "4")
    assert (row["mapped"], row["fromCS"], row["uniq"], row["uniq%"]) == ("4", "4", "3", "75.00%")
