"""Readers and writers on awkward files."""

import gzip
import os
import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from cutgrid.functions.sizing import broadcast_limit, measured, owned, shared_dir, small, stage
from cutgrid.operators import logs as lg, summary as sm
from cutgrid.operators.umis import group_positions, shift_plus
from cutgrid.sources import bgzf, blocks, fasta, ordered, sinks, tables as tb
from cutgrid.sources.fasta import read_fasta
from cutgrid.sources.fastq import read_fastq
from cutgrid.sources.sam import read_sam


def fastq_text(n, rng):
    out, rows = [], []
    for i in range(n):
        size = rng.randint(1, 60)
        seq = "".join(rng.choice("ACGTN") for _ in range(size))
        qual = "".join(rng.choice("@+!I~\"5") for _ in range(size))
        out.append(f"@read{i} extra\n{seq}\n+{'read' if i % 3 else ''}\n{qual}\n")
        rows.append((f"read{i}", seq, qual))
    return "".join(out), rows


@pytest.mark.parametrize("range_bytes", [61, 500, 1 << 20])
def test_fastq_ranges_lose_nothing(spark, tmp_path, range_bytes):
    text, rows = fastq_text(200, random.Random(range_bytes))
    (tmp_path / "LIB1_S1_R1.fastq").write_text(text)
    with gzip.open(tmp_path / "LIB2_S1_R1.fastq.gz", "wt") as out:
        out.write(text.rstrip("\n"))
    got = read_fastq(spark, str(tmp_path), range_bytes=range_bytes).collect()
    for lib in ("LIB1", "LIB2"):
        mine = sorted((r for r in got if r.libid == lib), key=lambda r: r.ord)
        assert [(r.read_id, r.seq, r.qual) for r in mine] == rows


def test_truncated_fastq_fails(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r1\nAC\n+\nII\n@r2\nAC\n")
    with pytest.raises(Exception, match="incomplete"):
        read_fastq(spark, str(tmp_path)).count()


@pytest.mark.parametrize("range_bytes", [40, 333, 1 << 20])
@pytest.mark.parametrize("gz", [False, True])
def test_fasta_chunks_rebuild_contigs(spark, tmp_path, range_bytes, gz):
    rng = random.Random(range_bytes)
    contigs, text = {}, ""
    for i, n in enumerate((130, 1, 0, 700, 59, 60, 61, 2_000)):
        seq = "".join(rng.choice("ACGTn") for _ in range(n))
        contigs[f"chr{i}"] = seq
        width = 25 if i % 2 else 4_000
        text += f">{i} dna:chromosome {i}\n" + "".join(seq[j:j + width] + "\n" for j in range(0, n, width))
    name = tmp_path / ("g.fa.gz" if gz else "g.fa")
    name.write_bytes(gzip.compress(text.encode()) if gz else text.encode())
    rows = read_fasta(spark, str(name), chunk=50, overlap=5, range_bytes=range_bytes).collect()
    for chrom, seq in contigs.items():
        parts = sorted((r for r in rows if r.chrom == chrom), key=lambda r: r.offset)
        assert "".join(r.seq[:r.span] for r in parts) == seq
        at = 0
        for r in parts:
            assert r.offset == at and r.seq == seq[at:at + r.span + 5]
            at += r.span


def test_sam_text(spark, tmp_path):
    lines = ["@HD\tVN:1.0", "@SQ\tSN:chr1\tLN:9", "r1\t16\tchr1\t5\t42\t10M\t*\t0\t0\tACGT\tIIII\tAS:i:-1\tXS:i:-9\tNM:i:0",
             "r2\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII", "r3\t0\tchr1\t7\t30\t4M\t=\t0\t0\tA\tI\tAS:i:-1"]
    (tmp_path / "LIB.sam").write_text("\n".join(lines) + "\n")
    got = {r.read_id: r for r in read_sam(spark, str(tmp_path)).collect()}
    assert set(got) == {"r1", "r2", "r3"} and got["r1"].libid == "LIB"
    assert (got["r1"].flag, got["r1"].pos, got["r1"].mapq, got["r1"].multi) == (16, 5, 42, True)
    assert not got["r2"].multi and not got["r3"].multi


def test_stranded_umis_keep_file_order_and_quotes(spark, tmp_path):
    (tmp_path / "L1.clean.plus.umi.txt").write_text("chr1\t104\tAC\t\"I\nchr1\t104\tGT\tI\"\n")
    with gzip.open(tmp_path / "L1.clean.revs.umi.txt.gz", "wt") as out:
        out.write("chr1\t100\tTT\t#I\n")
    long = tb.read_stranded_umis(spark, str(tmp_path / "*plus*"), str(tmp_path / "*revs*"))
    row = group_positions(shift_plus(long, 4)).first()
    assert (row.libid, row.pos, row.umi, row.qual) == ("L1", 100, ["AC", "GT", "TT"], ['"I', 'I"', "#I"])


def test_fastq_folders_patterns_and_missing_paths(spark, tmp_path):
    for lib in "AB":
        (tmp_path / "run" / f"libid={lib}" / "deep er").mkdir(parents=True)
        (tmp_path / "run" / f"libid={lib}" / "deep er" / "part-1.txt").write_text(f"@{lib}1 x\nAC\n+\nII\n")
    (tmp_path / "run" / "_SUCCESS").write_text("")
    for path in (str(tmp_path / "run"), f"file:{tmp_path}/run", str(tmp_path / "r*")):
        assert sorted((r.libid, r.read_id) for r in read_fastq(spark, path).collect()) == [("A", "A1"), ("B", "B1")]
    with pytest.raises(FileNotFoundError):
        read_fastq(spark, str(tmp_path / "none"))


def test_config_conditions_and_beds(spark, tmp_path):
    (tmp_path / "run.config").write_text("K1\tCATCACGC\nK2\tGTCGTATC\t\n\n")
    assert [tuple(r) for r in tb.read_config(spark, str(tmp_path / "run.config")).orderBy("libid").collect()] == [
        ("K1", "CATCACGC"), ("K2", "GTCGTATC"),
    ]
    (tmp_path / "meta.tsv").write_text(
        "cond\texid\tpath\tlibid\n" + "".join(f"{c}\tE\t{tmp_path}/{lib}.bed.gz\t{lib}\n" for c, lib in (("20s", "K2"), ("1min", "K1")))
    )
    for lib in ("K1", "K2"):
        with gzip.open(tmp_path / f"{lib}.bed.gz", "wt") as out:
            out.write(f"chr1 x\t5\t5\tpos_1\t{3 if lib == 'K1' else 8}\n")
    conditions = tb.read_conditions(spark, str(tmp_path / "meta.tsv"))
    assert [(r.cond, r.cond_order) for r in conditions.orderBy("cond_order").collect()] == [("20s", 1), ("1min", 2)]
    counts = tb.read_condition_counts(spark, conditions).collect()
    assert sorted((r.libid, r.chrom, r.start, r.score) for r in counts) == [("K1", "chr1", 5, 3), ("K2", "chr1", 5, 8)]
    files = tb.library_files(spark, str(tmp_path / "*.bed.gz"), ".").collect()
    assert sorted(r.libid for r in files) == ["K1", "K2"]


def test_condition_files_do_not_vanish(spark, tmp_path):
    """Blanks and signs in paths, names that end alike, folders; a path without a file or for two libraries fails."""
    places = {"A": tmp_path / "A.bed", "B": tmp_path / "old_A.bed", "C": tmp_path / "a b%20+c" / "A.bed", "D": tmp_path / "folder"}
    for i, (lib, place) in enumerate(places.items()):
        place.parent.mkdir(exist_ok=True)
        if lib == "D":
            place.mkdir()
            for part in (1, 2):
                (place / f"part-{part}.bed").write_text(f"chr1\t{part}\t{part}\tx\t{i}\n")
        else:
            place.write_text(f"chr1\t1\t1\tx\t{i}\n")
    rows = [("E", "x", i, lib, str(place)) for i, (lib, place) in enumerate(places.items())]
    schema = "exid string, cond string, cond_order int, libid string, fpath string"
    twice = [*rows, ("F", "x", 1, "A", str(places["A"]))]
    counts = tb.read_condition_counts(spark, spark.createDataFrame(twice, schema)).collect()
    assert sorted((r.libid, r.start, r.score) for r in counts) == [("A", 1, 0), ("B", 1, 1), ("C", 1, 2), ("D", 1, 3), ("D", 2, 3)]
    with pytest.raises(FileNotFoundError):
        tb.read_condition_counts(spark, spark.createDataFrame([*rows, ("E", "x", 9, "Z", str(tmp_path / "none.bed"))], schema))
    for wrong in (("F", "x", 1, "A", str(places["B"])), ("F", "x", 1, "Z", str(places["A"]))):
        with pytest.raises(ValueError):
            tb.read_condition_counts(spark, spark.createDataFrame([*rows, wrong], schema))


def write_logs(root, lib, skip=()):
    logs = {
        "quality": "start\nINFO 1/9 (11.11%) x flag_extract.py:246\nINFO 80/100 (80.00%) x flag_extract.py:246\n",
        "prefix": "INFO 60/80 (75.00%) x flag_regex.py:156\n",
        "mapping": "60 reads\n    5 (8.33%) aligned 0 times\n    50 (83%) aligned exactly 1 time\n    5 (8.33%) aligned >1 times\n",
        "chrM": "2\n", "low_mapq": "7\n", "clean": "45\n",
        "site": "INFO Intermediate: 40 (88.89%) UMI sequences over 3 (1%)\nINFO Output: 40 (88.89%) UMI sequences over 2 (1%)\n",
        "dedup": "40 non-orphan reads.\n10 (25.00%) duplicated UMIs.\n30 UMIs left after deduplication.\n",
    }
    for stage, (folder, suffix) in tb.LOG_FILES.items():
        (root / folder).mkdir(exist_ok=True)
        if stage not in skip:
            (root / folder / f"{lib}{suffix}").write_text(logs[stage])


def test_logs_to_summary(spark, tmp_path):
    write_logs(tmp_path, "K1")
    found = lg.log_metrics(tb.read_logs(spark, str(tmp_path)))
    row = sm.as_text(sm.summary_from_logs(lg.require_metrics(found), "RUN")).first().asDict()
    assert row == {
        "prep_run": "RUN", "library_id": "K1", "input": 100, "umi_hq": 80, "umi_hq%": "80.00%", "prefix": 60,
        "prefix%": "75.00%", "unmapped": 5, "2nd_aln": 5, "chrM": 2, "low_mapq": 7, "mapped": 45, "mapped%": "75.00%",
        "fromCS": 40, "fromCS%": "88.89%", "uniq": 30, "uniq%": "75.00%", "out%": "30.00%",
    }
    sinks.write_summary(sm.summary_from_logs(found, "RUN"), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text().splitlines()
    assert text[0].split("\t")[:3] == ["prep_run", "library_id", "input"] and text[1].split("\t")[4] == "80.00%"


def test_missing_log_line_is_reported(spark, tmp_path):
    write_logs(tmp_path, "K1", skip=("dedup",))
    found = lg.log_metrics(tb.read_logs(spark, str(tmp_path)))
    assert [tuple(r) for r in lg.missing_metrics(found).collect()] == [("K1", "uniq")]
    with pytest.raises(Exception, match="missing uniq line of library K1"):
        lg.require_metrics(found).collect()


def test_broadcasts_are_checked(spark):
    table = spark.range(2_000).withColumn("name", F.lit("x" * 100))
    _, rows, size = measured(table)
    assert rows == 2_000 and size > 200_000
    assert small(table)._jdf.queryExecution().logical().toString().startswith("UnresolvedHint broadcast")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        assert broadcast_limit(spark) == 100 << 10
        assert not small(table)._jdf.queryExecution().logical().toString().startswith("UnresolvedHint broadcast")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def blocked(data: bytes, size: int, level: int = 6) -> bytes:
    return b"".join(bgzf.member(data[at:at + size], level) for at in range(0, len(data), size)) + bgzf.END


@pytest.mark.parametrize("range_bytes", [97, 1500, 1 << 20])
def test_blocked_fastq_is_read_in_ranges(spark, tmp_path, range_bytes):
    text, rows = fastq_text(900, random.Random(range_bytes))
    (tmp_path / "LIB_S1_R1.fastq.gz").write_bytes(blocked(text.encode(), 1000))
    assert gzip.decompress((tmp_path / "LIB_S1_R1.fastq.gz").read_bytes()).decode() == text
    found = read_fastq(spark, str(tmp_path), range_bytes=range_bytes)
    got = found.withColumn("task", F.spark_partition_id()).collect()
    assert [(r.read_id, r.seq, r.qual) for r in sorted(got, key=lambda r: r.ord)] == rows
    if range_bytes == 1500:
        assert len({r.task for r in got}) >= 8


def test_damaged_blocks_fail(spark, tmp_path):
    text, _ = fastq_text(300, random.Random(4))
    data = bytearray(blocked(text.encode(), 1000))
    data[len(data) // 2] ^= 255
    (tmp_path / "LIB_S1.fastq.gz").write_bytes(bytes(data))
    with pytest.raises(Exception):
        read_fastq(spark, str(tmp_path), range_bytes=1 << 20).count()


def test_whole_gzip_files_are_named(tmp_path):
    path = tmp_path / "a.fastq.gz"
    path.write_bytes(gzip.compress(random.Random(1).randbytes(5000)))
    options = {"files": f'[["{path}", {path.stat().st_size}]]', "range_bytes": "1000", "least_bytes": "1000", "slices": "1"}
    with pytest.warns(UserWarning, match="a.fastq.gz"):
        assert [(r.start, r.end) for r in blocks.file_ranges(options)] == [(0, -1)]


def test_members_of_any_text(tmp_path):
    rng = random.Random(2)
    for data in (b"", b"x", bytes(200_000), rng.randbytes(200_000), b"ab\n" * 70_000):
        for level in (0, 1, 9):
            packed = bgzf.members(data, level) + bgzf.END
            assert gzip.decompress(packed) == data
            path = tmp_path / "m.gz"
            path.write_bytes(packed)
            file = blocks.file_system(str(path))[0].open_input_file(str(path))
            places = list(bgzf.read(file, 0))
            assert b"".join(text for _, text in places) == data
            for start in rng.sample(range(len(packed)), min(20, len(packed))):
                later = [place for place, _ in places if place >= start] + [len(packed) - len(bgzf.END)]
                assert bgzf.first_member(file, start, len(packed)) == (later[0] if start <= later[-1] else None)


@pytest.mark.parametrize("gz", [False, True])
def test_contig_on_one_line_is_shared_by_ranges(spark, tmp_path, gz):
    rng = random.Random(3)
    seq = "".join(rng.choice("ACGT") for _ in range(40_000))
    data = f">1 dna {'long header ' * 40}\n{seq}\n>2\nACGTAC\n".encode()
    path = tmp_path / ("g.fa.gz" if gz else "g.fa")
    path.write_bytes(blocked(data, 3000) if gz else data)
    rows = read_fasta(spark, str(path), chunk=500, overlap=7, range_bytes=len(path.read_bytes()) // 9).withColumn(
        "task", F.spark_partition_id()).collect()
    parts = sorted((r for r in rows if r.chrom == "chr1"), key=lambda r: r.offset)
    assert "".join(r.seq[:r.span] for r in parts) == seq and len({r.task for r in parts}) >= 7
    assert all(r.seq == seq[r.offset:r.offset + r.span + 7] for r in parts)
    assert [(r.offset, r.span, r.seq) for r in rows if r.chrom == "chr2"] == [(0, 6, "ACGTAC")]


def test_one_line_of_64_mb_is_read_in_bounded_memory(tmp_path):
    path, size = tmp_path / "g.fa", 64 << 20
    with open(path, "wb") as out:
        out.write(b">1 x\n")
        for _ in range(64):
            out.write(b"ACGT" * (1 << 18))
        out.write(b"\n")
    tracemalloc.start()
    spans = []
    for part, start in enumerate(range(0, size + 6, 16 << 20)):
        end = min(start + (16 << 20), size + 6)
        spans.append(sum(span for _, _, _, span, _ in fasta.Chunks(blocks.FileRange(str(path), part, start, end), 1 << 16, 64)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(spans) == size and min(spans[:4]) > 15 << 20 and peak < 48 << 20


def test_a_line_longer_than_memory_is_written_in_pieces(tmp_path):
    path = str(tmp_path / "part")
    tracemalloc.start()
    out = ordered.PartFile(path, 1)
    for i in range(400):
        out.add(i == 0, ("ACGTACGT " * 50_000)[i % 9:])
    out.add(True, "next")
    out.close()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    with gzip.open(path) as text:
        sizes = [len(line) for line in text]
    assert len(sizes) == 2 and sizes[0] > 170 << 20 and peak < 16 << 20


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("compress", [True, False])
def test_ordered_lines_across_tasks(spark, tmp_path, whole, compress):
    """Lists cut into many stretches over many tasks give the same lines as whole ones."""
    rng = random.Random(6)
    reads = [(lib, "chr1", rng.choice([5, 5, 5, 9]), "+", f"U{i:04d}", f"q{i}", i) for i in range(600) for lib in ("A", "B c")]
    frame = spark.createDataFrame(reads, "libid string, chrom string, pos long, strand string, umi string, qual string, ord long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = str(tmp_path / "out")
        sinks.write_grouped(group_positions(frame, max_rows=7), out, whole=whole, compress=compress, level=9)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted(str(p.relative_to(out)) for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.endswith(".crc"))
    suffix = ".gz" if compress else ""
    if whole:
        assert names == [f"A.txt{suffix}", f"B c.txt{suffix}"]
    for lib in ("A", "B c"):
        files = [n for n in names if n.startswith(f"{lib}." if whole else f"libid={lib}/")]
        data = [(tmp_path / "out" / n).read_bytes() for n in files]
        lines = b"".join(gzip.decompress(x) if compress else x for x in data).decode().splitlines()
        wanted = []
        for pos in sorted({r[2] for r in reads if r[0] == lib}):
            own = [r for r in reads if r[0] == lib and r[2] == pos]
            wanted.append(f"chr1\t{pos}\t{' '.join(r[4] for r in own)}\t{' '.join(r[5] for r in own)}")
        assert lines == wanted
    with pytest.raises(FileExistsError):
        sinks.write_grouped(group_positions(frame), str(tmp_path / "out"))


def test_gzip_level_is_an_argument(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit("A").alias("libid"), F.md5(F.col("id").cast("string")).alias("text"))
    sizes = []
    for level in (1, 9):
        sinks.write_tsv(rows.coalesce(1), str(tmp_path / f"tsv{level}"), level=level)
        sinks.write_reads(
            rows.select("libid", F.col("text").alias("read_id"), F.repeat("text", 3).alias("seq"), F.repeat("text", 3).alias("qual")),
            str(tmp_path / f"fastq{level}"), whole=True, level=level)
        sizes.append((sum(p.stat().st_size for p in (tmp_path / f"tsv{level}").glob("part*")), (tmp_path / f"fastq{level}" / "A.fastq.gz").stat().st_size))
    assert sizes[0][0] > sizes[1][0] and sizes[0][1] > sizes[1][1]


def test_ordered_files_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "libid string, chrom string, start long, end long, name string, score long")
    sinks.write_site_bed(empty, str(tmp_path / "bed"), whole=True)
    assert [p.name for p in (tmp_path / "bed").iterdir() if not p.name.endswith(".crc")] == []
    with pytest.raises(ValueError, match="a/b"):
        sinks.write_site_bed(empty.unionByName(spark.createDataFrame([("a/b", "c", 1, 1, "n", 2)], empty.schema)), str(tmp_path / "bad"), whole=True)


def test_line_numbers_across_splits(spark, tmp_path):
    """A log in many splits, with another one beside it: numbers follow the file, and the last matching line wins."""
    (tmp_path / "dedup").mkdir()
    (tmp_path / "fastq_hq").mkdir()
    lines = [f"INFO {i}/{i + 9} ({i % 90}.5%) reads flag_extract.py:246" if i % 7 == 0 else f"noise {i} " * 5 for i in range(20_000)]
    (tmp_path / "fastq_hq" / "K1.log").write_text("\r\n".join(lines) + "\r\n")
    (tmp_path / "fastq_hq" / "K2.log").write_text("INFO 1/2 (50%) flag_extract.py:246\n")
    (tmp_path / "dedup" / "K1.clean.umis_at_cs.txt.gz.umi_prep_notes.txt").write_text("5 UMIs left after deduplication.\n" * 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = tb.read_logs(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 8
        assert [r.line for r in found.filter("libid = 'K1' and stage = 'quality'").orderBy("line_no").collect()] == lines
        numbers = [r.line_no for r in found.filter("libid = 'K1' and stage = 'quality'").orderBy("line_no").collect()]
        assert numbers == list(range(20_000))
        metrics = {r.libid: r for r in lg.log_metrics(found).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (metrics["K1"].umi_hq, metrics["K1"].input, metrics["K1"].uniq, metrics["K2"].umi_hq) == (19_999, 20_008, 5, 1)


def test_staged_tables_go_with_their_scope(spark, tmp_path):
    def staged():
        return {p for p in os.listdir(shared_dir(spark).removeprefix("file:"))}

    before = staged()
    with owned(spark) as scope:
        one = stage(spark.range(5))
        kept, path = scope.keep(stage(one.filter("id > 1")))
        assert len(staged() - before) == 3
    assert staged() - before == {os.path.basename(path)} and kept.count() == 3
    with pytest.raises(ZeroDivisionError), owned(spark):
        stage(spark.range(1)).count() / 0
    with owned(spark) as scope:
        scope.add(path)
    assert staged() == before
    outside = stage(spark.range(2))
    assert outside.count() == 2 and len(staged() - before) == 1
