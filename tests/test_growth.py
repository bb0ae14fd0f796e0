"""What must not grow with the tables: tasks for small ranges, bytes read behind a range, steps of a search."""

import gzip
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from cutgrid.functions import sizing
from cutgrid.operators import bins as bn, scores as sc, umis as um
from cutgrid.operators.intervals import index_sites, intervals_outside_mask, nearest
from cutgrid.params import ScoreParams
from cutgrid.plans.catalog import runs
from cutgrid.plans.score import score
from cutgrid.sources import bgzf, blocks, fastq, ordered, sinks, tables as tb
from cutgrid.sources.sam import read_sam


def test_small_ranges_share_tasks(tmp_path):
    path = tmp_path / "a.fa"
    path.write_bytes(b">1\n" + b"ACGT" * 50_000)
    size = path.stat().st_size
    options = {"files": json.dumps([[str(path), size]]), "range_bytes": "100", "least_bytes": "100", "slices": "1", "task_bytes": str(1 << 20), "cores": "2"}
    dealt = blocks.dealt_ranges(options)
    assert 8 <= len(dealt) <= 9
    assert [r for task in dealt for r in task.ranges] == blocks.file_ranges(options)
    few = blocks.dealt_ranges(options | {"range_bytes": "50000", "least_bytes": "50000"})
    assert all(len(task.ranges) == 1 for task in few)


def test_little_is_read_behind_a_small_range(tmp_path):
    path = tmp_path / "a.txt"
    path.write_bytes(b"ACGTACG\n" * 100_000)
    read = list(zip(range(2), blocks.RangeBytes(blocks.FileRange(str(path), 1, 8000, 9000))))
    assert sum(len(block) for _, (_, block) in read) < 10_000


def test_small_ranges_of_blocked_files_read_little(tmp_path):
    rng = random.Random(1)
    path, seen = tmp_path / "a.gz", []
    path.write_bytes(bgzf.members(rng.randbytes(8 << 20), 1) + bgzf.END)

    class Counted:
        def __init__(self, file):
            self.file = file

        def read_at(self, count, place):
            data = self.file.read_at(count, place)
            seen.append(len(data))
            return data

    with blocks.file_system(str(path))[0].open_input_file(str(path)) as file:
        next(bgzf.read(Counted(file), 0, 1 << 17))
    assert sum(seen) == 1 << 17


def test_pieces_are_joined_as_they_are_added_one_by_one(tmp_path):
    import pyarrow as pa

    rng = random.Random(2)
    opens = [rng.random() < 0.6 for _ in range(3000)]
    texts = [rng.choice("äßx ") * rng.randint(0, 2000) for _ in opens]
    one, many = ordered.PartFile(str(tmp_path / "one"), 1), ordered.PartFile(str(tmp_path / "many"), 1)
    for begins, text in zip(opens, texts):
        one.add(begins, text)
    for at in (0, 1, 1000, 1001):
        end = {0: 1, 1: 1000, 1000: 1001, 1001: 3000}[at]
        many.add_all(pa.array(opens[at:end]), pa.array(texts[at:end]))
    one.close(), many.close()
    with gzip.open(tmp_path / "one") as a, gzip.open(tmp_path / "many") as b:
        assert a.read() == b.read()


def test_spread_reads_follow_the_files(spark, tmp_path, monkeypatch):
    with gzip.open(tmp_path / "A_S1.fastq.gz", "wt") as out:
        out.writelines(f"@r{i}\n{random.Random(i).choice('ACGT') * 30}\n+\n{'I' * 30}\n" for i in range(2000))
    size = (tmp_path / "A_S1.fastq.gz").stat().st_size
    assert fastq.read_fastq(spark, str(tmp_path), partitions=3).rdd.getNumPartitions() == 3
    monkeypatch.setattr(fastq, "SPREAD_BYTES", size // 10)
    found = fastq.read_fastq(spark, str(tmp_path), partitions=3)
    assert found.rdd.getNumPartitions() >= 10 and found.select("read_id").distinct().count() == 2000


def test_blocked_beds_are_read_in_ranges(spark, tmp_path):
    for lib, shift in (("A", 0), ("B", 7)):
        text = "".join(f"chr1 x\t{i + shift}\t{i + shift}\tpos_{i}\t{i % 5}\n" + ("\n" if i % 500 == 0 else "") for i in range(4000))
        data = text.encode()
        (tmp_path / f"{lib}.bed.gz").write_bytes(b"".join(bgzf.member(data[at:at + 900]) for at in range(0, len(data), 900)) + bgzf.END)
    (tmp_path / "C.bed.gz").write_bytes(gzip.compress(b"chr2\t5\t5\tpos_1\t3\n"))
    (tmp_path / "D.bed").write_bytes(b"chr2\t6\t6\tpos_1\t4\n")
    paths = [(name[0], str(tmp_path / name)) for name in ("A.bed.gz", "B.bed.gz", "C.bed.gz", "D.bed")]
    conditions = spark.createDataFrame(paths, "libid string, fpath string")
    kept = {key: spark.conf.get(key, None) for key in ("spark.sql.files.openCostInBytes", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        found = tb.read_condition_counts(spark, conditions)
        got = {(r.libid, r.chrom, r.start): r.score for r in found.collect()}
        files = blocks.list_files(spark, str(tmp_path / "A.bed.gz"))
        from cutgrid.sources.lines import read_lines
        lines = read_lines(spark, files)
        assert lines.rdd.getNumPartitions() > 1 and lines.filter("line != ''").count() == 4000
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    wanted = {(lib, "chr1", i + shift): i % 5 for lib, shift in (("A", 0), ("B", 7)) for i in range(4000)}
    assert got == wanted | {("C", "chr2", 5): 3, ("D", "chr2", 6): 4}


def test_a_malformed_line_of_a_blocked_bed_fails(spark, tmp_path):
    (tmp_path / "A.bed.gz").write_bytes(bgzf.members(b"chr1\t5\t5\tpos_1\tmany\n") + bgzf.END)
    conditions = spark.createDataFrame([("A", str(tmp_path / "A.bed.gz"))], "libid string, fpath string")
    with pytest.raises(Exception, match="(?i)malformed"):
        tb.read_condition_counts(spark, conditions).collect()


def test_search_in_a_cell_is_a_plain_column(spark):
    """No function over list elements, which Spark does not compile; dense and sparse cells, both ends and ties."""
    rng = random.Random(3)
    places = sorted({*rng.sample(range(20_000), 6_000), *rng.sample(range(200_000), 40), 9_000_000})
    sites = spark.createDataFrame([("chr1", p) for p in places], "chrom string, start long")
    asked = [-70_000, -1, 0, 16_383, 16_384, 8_999_999, 9_000_000, 50_000_000, *rng.sample(range(210_000), 3_000)]
    points = spark.createDataFrame([("chr1", p) for p in asked], "chrom string, pos long")
    for most in (None, 0):
        found = nearest(points, index_sites(sites, max_bytes=most))
        assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
        assert {r.pos: r.site for r in found.collect()} == {p: min(places, key=lambda s: (abs(s - p), s)) for p in asked}


@pytest.mark.parametrize("most", [None, 0])
def test_predicates_stay_behind_the_search(spark, most):
    """A filter on the distance, the site or both leaves the steps as they are; moved in front of them it would double the plan with each."""
    rng = random.Random(4)
    places, asked = sorted(rng.sample(range(100_000), 300)), [*rng.sample(range(100_000), 500), -300, 200_000]
    sites = spark.createDataFrame([("chr1", p) for p in places], "chrom string, start long")
    points = spark.createDataFrame([("chr1", p) for p in [*asked, None]], "chrom string, pos long")
    found = um.assign(points, index_sites(sites, max_bytes=most))
    assert found.columns == ["chrom", "pos", "site", "dist", "is_orphan"]
    nearby = {p: min(places, key=lambda s: (abs(s - p), s)) for p in asked}
    for wanted, holds in (("not is_orphan", lambda p, s: abs(p - s) <= 20), ("is_orphan", lambda p, s: abs(p - s) > 20),
                          ("site > 50000 and dist < 100", lambda p, s: s > 50_000 and abs(p - s) < 100)):
        kept = found.filter(wanted)
        assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 20_000
        assert {r.pos: r.site for r in kept.collect()} == {p: s for p, s in nearby.items() if holds(p, s)}


@pytest.mark.parametrize("limit", ["0", "10m"])
def test_tasks_of_a_universe_follow_its_rows(spark, monkeypatch, limit):
    """Rows per task stay the same, whatever the tables' size; repeated counts and keys without values stay what a left join makes of them."""
    monkeypatch.setattr(sizing, "TASK_ROWS", 1000, raising=False)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        odd = spark.createDataFrame([("A", "chr1", 1, 50), ("A", "chr1", None, 7), ("B", None, 2, 8), (None, "chr1", 3, 9)],
                                    "libid string, chrom string, start long, score long")
        counts = spark.range(6000).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("libid"), F.lit("chr1").alias("chrom"),
                                          (F.col("id") * 2 % 8191).alias("start"), (F.col("id") % 7 + 1).alias("score")).unionByName(odd)
        sites = spark.range(4000).select(F.lit("chr1").alias("chrom"), F.col("id").alias("start")).unionByName(
            spark.createDataFrame([("chr1", None), ("chr1", 5), (None, 2)], "chrom string, start long"))
        libraries = spark.createDataFrame([("A",), ("B",), ("B",), ("C",)], "libid string")
        found = bn.universe_sites(counts, sites, libraries)
        got = sorted(map(str, found.collect()))
        if limit == "0":
            sizes = [n for n in found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
            assert len(sizes) >= 12 and max(sizes) <= 1500
        have = {}
        for r in counts.collect():
            have.setdefault((r.libid, r.chrom, r.start), []).append(r.score)
        wanted = [(lib, r.chrom, r.start, score) for r in sites.distinct().collect() for lib in "ABC"
                  for score in ([0] if r.chrom is None or r.start is None else have.get((lib, r.chrom, r.start), [0]))]
        row = type(found.first())
        assert got == sorted(str(row(libid=a, chrom=b, start=c, score=x)) for a, b, c, x in wanted)
        none = bn.universe_sites(counts.limit(0), sites, libraries).agg(F.count("*"), F.sum("score")).first()
        assert tuple(none) == (3 * 4002, 0)
        assert bn.universe_sites(counts, sites, libraries.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_bins_made_out_of_lengths_are_measured(spark, tmp_path):
    """The file of lengths has a few bytes and its bins do not, so the planner must not broadcast them on its own."""
    (tmp_path / "sizes").write_text("chr1\t0\t4000000\nchr2\t0\t900\n")
    (tmp_path / "mask").write_text("".join(f"chr1\t{p}\t{p + 1500}\tm\n" for p in range(0, 4_000_000, 100_000)))
    rng = random.Random(5)
    points = [("chr1", rng.randrange(4_000_000)) for _ in range(400)] + [("chr2", 5)]
    sites = spark.createDataFrame(points, "chrom string, start long").distinct()
    counts = spark.createDataFrame([(lib, c, p, 1 + p % 3) for lib in "AB" for c, p in {*points}], "libid string, chrom string, start long, score long")
    conditions = spark.createDataFrame([("E", "1min", 1, "A"), ("E", "5min", 2, "B")], "exid string, cond string, cond_order int, libid string")
    params = ScoreParams(bin_tags="1e3:1e3", site_domain="universe", chromosome_wide=True)
    sizes, mask = tb.read_bed(spark, str(tmp_path / "sizes"), 3), tb.read_bed(spark, str(tmp_path / "mask"))
    kept, scored, seen = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), {}, []

    def noted(rates, *more):
        seen.append(rates._jdf.queryExecution().executedPlan().toString())
        return bin_scores(rates, *more)

    bin_scores = sc.bin_scores
    for limit in ("50k", "100m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            with pytest.MonkeyPatch.context() as patched:
                patched.setattr(sc, "bin_scores", noted)
                scored[limit] = sorted(map(str, score(counts, conditions, sizes, params, sites=sites, mask=mask).collect()))
            left = intervals_outside_mask(bn.make_bins(sizes, params.tags), mask)
            seen.append(left._jdf.queryExecution().executedPlan().toString())
            assert left.count() == 4001 - 40 * 2
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    joined = [re.findall(r"BroadcastHashJoin \[(?:bin_tag#\d+, chrom|chrom#\d+, (?:start|end))", plan) for plan in seen]
    assert [len(found) for found in joined[:2]] == [0, 0] and joined[2]
    assert scored["50k"] == scored["100m"] and scored["50k"]


def test_alignments_are_blocked_gzip_and_read_in_ranges(spark, tmp_path):
    """What a run writes takes little disk and no task reads a whole library; plain and ordinary gzip files beside it are read as before."""
    rows = [("A" if i % 3 else "B+ %x", f"r{i:05d}", 16 * (i % 2), "chr1", i, i % 50, "4M", i % 7 == 0, "ACGT", "IIII") for i in range(6000)]
    table = spark.createDataFrame(rows, "libid string, read_id string, flag int, chrom string, pos long, mapq int, cigar string, multi boolean, "
                                        "umi string, umi_qual string")
    runs._write_sam(table, str(tmp_path / "sam"))
    assert sorted(p.name for p in (tmp_path / "sam").iterdir() if p.suffix == ".gz") == ["A.sam.gz", "B+ %x.sam.gz"]
    assert all(bgzf.size_at(p.read_bytes()) for p in (tmp_path / "sam").glob("*.gz"))
    text = "".join(f"x{i}~~umi~AC~~qumi~II\t0\tchr2\t{i}\t40\t4M\t*\t0\t0\t*\t*\n" for i in range(2000)).encode()
    (tmp_path / "sam" / "A.sam.gz").write_bytes(b"".join(  # members end inside lines
        bgzf.member(part) for whole in [gzip.decompress((tmp_path / "sam" / "A.sam.gz").read_bytes())]
        for part in (whole[at:at + 9001] for at in range(0, len(whole), 9001))) + bgzf.END)
    (tmp_path / "sam" / "C.more.sam").write_bytes(b"@HD\tVN:1\r\n\n" + text)
    (tmp_path / "sam" / "D.sam.gz").write_bytes(gzip.compress(text))
    kept = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        found = read_sam(spark, str(tmp_path / "sam"))
        tasks = found.filter("libid = 'A'").groupBy(F.spark_partition_id()).count().count()
        got = {(r.libid, r.read_id): tuple(r)[2:7] + (r.multi,) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", kept)
    wanted = {(lib, f"{name}~~umi~{umi}~~qumi~{qual}"): (flag, chrom, pos, mapq, cigar, multi)
              for lib, name, flag, chrom, pos, mapq, cigar, multi, umi, qual in rows}
    wanted |= {(lib, f"x{i}~~umi~AC~~qumi~II"): (0, "chr2", i, 40, "4M", False) for lib in "CD" for i in range(2000)}
    assert got == wanted and found.count() == len(wanted) and tasks > 1
    (tmp_path / "none").mkdir()
    assert read_sam(spark, str(tmp_path / "none")).count() == 0


def test_shuffles_go_when_their_query_ends(spark, tmp_path):
    """Neither staged tables nor ordered files leave what was shuffled for them until the driver collects its garbage."""
    def shuffled():
        blocks_on_disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for name in re.findall(r"shuffle_(\d+)_", blocks_on_disk.mkString(" "))}

    def left(make):
        before = shuffled()
        make()
        until = time.time() + 20
        while (more := shuffled() - before) and time.time() < until:
            time.sleep(0.2)
        return more

    rows = spark.range(2000).select(F.lit("A").alias("libid"), F.col("id").alias("pos"), F.lit(True).alias("opens"), F.col("id").cast("string").alias("text"))
    kept = spark.conf.get(sizing._CLEANUP)
    assert not left(lambda: sizing.stage(rows.repartition(3, "pos")))
    assert not left(lambda: ordered.write_ordered(rows, str(tmp_path / "out"), ["pos"]))
    assert spark.conf.get(sizing._CLEANUP) == kept
    assert gzip.decompress((tmp_path / "out" / "A.txt.gz").read_bytes()).split() == [str(i).encode() for i in range(2000)]
