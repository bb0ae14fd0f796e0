"""Flags, quality, barcodes, profiles, alignments, motifs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cutgrid.functions import text as tx
from cutgrid.operators import alignments as aln, motif as mo, quality as qu, reads as rd
from cutgrid.plans.preprocess import flag_reads

PATTERN = "umi8bc8cs4"


def test_flags_and_status(spark):
    good, one_low, two_low = "I" * 8, "I" * 7 + "!", "I" * 6 + "!!"
    seq = "ACGTACGT" + "CATCACGC" + "GATC" + "TTGACA"
    rows = [("L", f"r{i}", seq, q + "I" * 18) for i, q in enumerate((good, one_low, two_low))]
    rows.append(("L", "r3", "ACGT", "IIII"))
    flagged = rd.flag_status(rd.extract_flags(spark.createDataFrame(rows, "libid string, read_id string, seq string, qual string"), PATTERN))
    got = {r.read_id: r for r in flagged.collect()}
    assert [got[f"r{i}"].status for i in range(4)] == ["hq", "hq", "lq", "unmatched"]
    r = got["r0"]
    assert (r.umi, r.bc, r.cs, r.seq, len(r.qual), r.umi_qual) == ("ACGTACGT", "CATCACGC", "GATC", "TTGACA", 6, good)
    assert (got["r3"].umi, got["r3"].seq) == (None, "ACGT")


@pytest.mark.parametrize(("flag", "ok"), [("GATC", True), ("GATG", True), ("GTTG", False), ("ATCG", False), ("GAT", False)])
def test_substitutions_do_not_allow_shifts(spark, flag, ok):
    row = spark.createDataFrame([(flag,)], "f string").select(rd.flag_matches("f", F.lit("GATC"), 4).alias("ok")).first()
    assert row.ok is ok


def test_prefix_uses_each_librarys_barcode(spark):
    config = spark.createDataFrame([("A", "CATCACGC"), ("B", "GTCGTCGC")], "libid string, barcode string")
    body = "ACGTACGT{}GATCAAAA"
    rows = [(lib, body.format(bc), "I" * 24) for lib in "AB" for bc in ("CATCACGC", "GTCGTCGC", "GTCGTCGA")]
    reads = spark.createDataFrame(rows, "libid string, seq string, qual string").withColumn("read_id", F.lit("r"))
    got = flag_reads(reads, config).filter("prefix_ok").select("libid", "bc").collect()
    assert sorted(map(tuple, got)) == [("A", "CATCACGC"), ("B", "GTCGTCGA"), ("B", "GTCGTCGC")]


def test_top_flag_check(spark):
    rows = [("A", "TTTTTTTT", "GATC")] * 2 + [("A", "CATCACGC", "GATC")] * 2 + [("A", "GGGGGGGG", "AAAA")]
    flagged = spark.createDataFrame(rows, "libid string, bc string, cs string").withColumn("matched", F.lit(True))
    config = spark.createDataFrame([("A", "CATCACGC")], "libid string, barcode string")
    top = {r.flag: r for r in rd.flag_top(rd.flag_stats(flagged), rd.expected_flags(config, "GATC")).collect()}
    assert (top["bc"].value, top["bc"].n, top["bc"].is_expected) == ("CATCACGC", 2, True)
    assert (top["cs"].value, top["cs"].n) == ("GATC", 4)


def test_flag_shares_scan_reads_once(spark):
    rows = spark.range(100).select(
        F.lit("A").alias("libid"), F.col("id").cast("string").alias("bc"), F.lit("x").alias("cs"), F.lit(True).alias("matched")
    )
    stats = rd.flag_stats(rows)
    stats.collect()
    assert "ReusedExchange" in stats._jdf.queryExecution().executedPlan().toString()


def test_quality_profile(spark):
    reads = spark.createDataFrame([("L", "ACGT", "!5I~"), ("L", "GG", "II"), ("L", "", "")], "libid string, seq string, qual string")
    by_pos = {r.pos: r for r in qu.quality_by_position(reads).collect()}
    assert (by_pos[1].n, by_pos[1].mean_q, by_pos[1].median, by_pos[1].q3) == (2, 20.0, 0, 40)
    assert (by_pos[4].n, by_pos[4].p90) == (1, 93)
    hist = {(r.measure, r.value): r.n for r in qu.read_histograms(reads).collect()}
    assert hist == {("length", 4): 1, ("length", 2): 1, ("length", 0): 1, ("gc_percent", 50): 1, ("gc_percent", 100): 1,
                    ("mean_quality", 38): 1, ("mean_quality", 40): 1}
    bases = {(r.pos, r.base): r.n for r in qu.base_composition(reads).collect()}
    assert bases == {(1, "A"): 1, (1, "G"): 1, (2, "C"): 1, (2, "G"): 1, (3, "G"): 1, (4, "T"): 1}
    levels = qu.duplication_levels(reads.union(reads)).collect()
    assert [(r.copies, r.n_sequences, r.n_reads) for r in levels] == [(2, 3, 6)]
    assert qu.overrepresented(reads, 0.5).count() == 0


def test_alignment_filter_and_positions(spark):
    rows = [
        ("ok+", 0, "chr1", 101, 30, "50M", "*"), ("ok-", 16, "chr1", 101, 60, "5S10M2I3D5N4=1X6H", "*"),
        ("low", 0, "chr1", 1, 29, "5M", "*"), ("second", 256, "chr1", 1, 60, "5M", "*"),
        ("unmapped", 4, "*", 0, 0, "*", "*"), ("mito", 0, "chrM", 1, 60, "5M", "*"),
        ("chimera", 1, "chr1", 1, 60, "5M", "chr2"), ("mates", 1, "chr1", 1, 60, "5M", "="), ("lone", 9, "chr1", 1, 60, "5M", "chr2"),
    ]
    table = spark.createDataFrame(
        [("L", *r, "ACGT", "IIII") for r in rows],
        "libid string, read_id string, flag int, chrom string, pos long, mapq int, cigar string, rnext string, umi string, umi_qual string",
    )
    clean = aln.filter_alignments(table)
    assert {r.read_id for r in clean.collect()} == {"ok+", "ok-", "mates", "lone"}
    got = {r.ord: (r.strand, r.pos) for r in aln.positioned_umis(clean).collect()}
    assert got["ok+"] == ("+", 100) and got["ok-"] == ("-", 100 + 10 + 3 + 5 + 4 + 1)
    counts = aln.alignment_counts(table).first().asDict()
    assert counts == {"libid": "L", "unmapped": 1, "low_mapq": 2, "chrM": 1, "mapped": 4}


def test_umi_through_the_read_name(spark):
    flagged = rd.extract_flags(
        spark.createDataFrame([("r:1", "ACGTACGTCATCACGCGATCTT", "ABCDEFGH" + "I" * 14)], "read_id string, seq string, qual string"), PATTERN
    )
    back = aln.umi_from_name(flagged.select(rd.flagged_name(PATTERN).alias("read_id"))).first()
    assert back.read_id.startswith("r:1~~umi~ACGTACGT~~bc~") and (back.umi, back.umi_qual) == ("ACGTACGT", "ABCDEFGH")


@pytest.mark.parametrize("motif", ["GATC", "AA", "ACA"])
def test_motif_is_brute_force_across_pieces_and_chunks(spark, motif):
    rng = random.Random(len(motif))
    contigs = {f"c{i}": "".join(rng.choice("ACGTacgtN") for _ in range(n)) for i, n in enumerate((0, 3, 1024, 40_000, 70_001))}
    contigs["c9"] = "A" * 2_050
    size, rows = 33_000, []
    for name, text in contigs.items():
        for at in range(0, len(text), size):
            rows.append((name, at, min(size, len(text) - at), text[at:at + size + len(motif) - 1]))
    hits = mo.find_motif(spark.createDataFrame(rows, "chrom string, offset long, span long, seq string"), motif)
    want = {
        (c, i, i + len(motif)) for c, text in contigs.items()
        for i in range(len(text)) if text[i:i + len(motif)].upper() == motif
    }
    got = [(r.chrom, r.start, r.end) for r in hits.collect()]
    assert len(got) == len(want) and set(got) == want


def test_small_expressions(spark):
    row = spark.range(1).select(
        tx.first_token(F.lit("chr1 dna x")).alias("a"), tx.library_id(F.lit("/x/TUT_S1_R1.fastq.gz")).alias("b"),
        tx.dir_name(F.lit("/x/y/z.txt")).alias("c"), tx.phred(F.lit("I")).alias("d"), tx.percent_text(F.lit(12.345)).alias("e"),
        tx.whole_number(F.lit(" 12 ")).alias("f"), tx.duration_seconds(F.lit("2.5min")).alias("g"),
        tx.duration_seconds(F.lit("soon")).alias("h"), tx.percent(F.lit(1), F.lit(0)).alias("i"),
    ).first()
    assert tuple(row)[:4] == ("chr1", "TUT", "/x/y", 40) and row.e in ("12.34%", "12.35%")
    assert (row.f, row.g, row.h, row.i) == (12, 150.0, None, None)


def test_overrepresented_by_a_summary_is_exact(spark):
    """Many rare sequences around the share: what is found, and its counts, are those of a full count."""
    rng = random.Random(5)
    reads = [("A", f"S{i}") for i in range(300) for _ in range(1 + i // 10)] + [("B", f"T{i}") for i in range(2_000)] + [("B", "often")] * 40
    rng.shuffle(reads)
    frame = spark.createDataFrame(reads, "libid string, seq string").repartition(6)
    total = {lib: sum(x == lib for x, _ in reads) for lib in "AB"}
    for share in (0.02, 0.005, 0.001, 1e-6):
        wanted = {(lib, seq): n for (lib, seq), n in Counter(reads).items() if n > total[lib] * share}
        found = qu.overrepresented(frame, share).collect()
        assert {(r.libid, r.seq): r.n for r in found} == wanted
