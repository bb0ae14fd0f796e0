"""A whole run on small files: what it leaves, and what it does again."""

import gzip

import pytest

from cutgrid.params import ScoreParams
from cutgrid.plans import run as rn
from cutgrid.sources.bgzf import size_at

PARAMS = ScoreParams(bin_tags="100:100", site_domain="universe", chrom_tag="1:X")


@pytest.fixture()
def files(tmp_path):
    (tmp_path / "fastq").mkdir()
    (tmp_path / "mapping").mkdir()
    (tmp_path / "config").write_text("K1\tACGTACGT\nK2\tTTTTCCCC\n")
    (tmp_path / "sites.bed").write_text("".join(f"chr1\t{p}\t{p + 4}\ts{p}\n" for p in range(50, 1000, 100)))
    (tmp_path / "sizes").write_text("chr1\t0\t1000\n")
    for lib, barcode, often in (("K1", "ACGTACGT", 3), ("K2", "TTTTCCCC", 7)):
        reads, lines = [], ["@HD\tVN:1"]
        for i in range(120):
            umi = "".join("ACGT"[i >> 2 * k & 3] for k in range(8))
            low = "!" * 8 if i % 10 == 9 else "I" * 8
            bc = "AAAAAAAA" if i % 10 == 8 else barcode
            reads.append(f"@{lib}.{i} x\n{umi}{bc}GATCAAAA\n+\n{low}{'I' * 16}\n")
            if i % 10 < 8:
                name = f"{lib}.{i}~~umi~{umi}~~bc~{bc}~~cs~GATC~~qumi~IIIIIIII~~qbc~IIIIIIII~~qcs~IIII"
                pos = 50 + 100 * ((i // 10 + i) * often % 10) + i % 3 + 5
                lines.append(f"{name}\t0\tchr1\t{pos}\t40\t4M\t*\t0\t0\tAAAA\tIIII\tAS:i:0")
        (tmp_path / "fastq" / f"{lib}.fastq.gz").write_bytes(gzip.compress("".join(reads).encode()))
        (tmp_path / "mapping" / f"{lib}.sam").write_text("\n".join(lines) + "\n")
    (tmp_path / "meta").write_text("exid\tcond\tlibid\tfpath\n" + "".join(
        f"E\t{i}min\t{lib}\t{tmp_path}/out/bed/{lib}.bed.gz\n" for i, lib in enumerate(("K1", "K2"), 1)))
    return tmp_path


def arguments(files, **more):
    return {"config": str(files / "config"), "fastq": str(files / "fastq"), "score_params": PARAMS, **more}


def aligned(files, **more):
    return arguments(files, sam=str(files / "mapping"), sites=str(files / "sites.bed"), conditions=str(files / "meta"),
                     sizes=str(files / "sizes"), **more)


def test_run_goes_on_behind_the_last_stage(spark, files, monkeypatch):
    out = str(files / "out")
    assert rn.run(spark, out, **arguments(files)).made == ["prepared"]
    prefix = files / "out" / "prepared" / "fastq_prefix"
    assert sorted(p.name for p in prefix.glob("*.gz")) == ["K1.fastq.gz", "K2.fastq.gz"]
    assert size_at((prefix / "K1.fastq.gz").read_bytes()) and gzip.decompress((prefix / "K1.fastq.gz").read_bytes()).count(b"~~umi~") == 96
    assert sorted(p.name for p in (files / "out" / "prepared" / "fastq_rejected").glob("*.gz")) == [
        f"{lib}.{why}.fastq.gz" for lib in ("K1", "K2") for why in ("lq", "prefix_unmatched")]

    def lost(*_, **__):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(rn, "score_files", lost)
        with pytest.raises(RuntimeError, match="gone"):
            rn.run(spark, out, **aligned(files))
    done = rn.run(spark, out, **aligned(files))
    assert done.made == ["scores"] and set(done.paths) == {"prepared", "counts", "bed", "summary_table", "scores"}
    assert rn.run(spark, out, **aligned(files)).made == []
    lines = gzip.decompress((files / "out" / "bed" / "K1.bed.gz").read_bytes()).decode().splitlines()
    assert lines[0].split("\t")[:4] == ["chr1", "50", "50", "pos_1"] and [int(x.split("\t")[1]) for x in lines] == list(range(50, 1000, 100))
    rows = {r["library_id"]: r for r in spark.read.option("sep", "\t").option("header", True).csv(done.paths["summary_table"]).collect()}
    assert (rows["K1"]["input"], rows["K1"]["umi_hq"], rows["K1"]["prefix"], rows["K1"]["mapped"], rows["K1"]["out%"]) == ("120", "108", "96", "96", "80.00%")
    scores = spark.read.option("sep", "\t").option("header", True).csv(done.paths["scores"])
    assert scores.count() == 10 and scores.filter("score is null").count() == 0
    tables = done.tables
    assert set(tables) == {"read_counts", "sites", "counts", "stats", "alignment_counts", "bed", "summary", "scores"}
    assert {r.library_id: (r.input, r.mapped) for r in tables["summary"].collect()} == {"K1": (120, 96), "K2": (120, 96)}
    assert tables["scores"].count() == 10 and tables["bed"].filter("libid = 'K1'").count() == len(lines)


def test_changed_inputs_repeat_what_depends_on_them(spark, files):
    out = str(files / "out")
    assert rn.run(spark, out, **aligned(files)).made == ["prepared", "counts", "bed", "summary_table", "scores"]
    (files / "sizes").write_text("chr1\t0\t1000\nchrX\t0\t10\n")
    assert rn.run(spark, out, **aligned(files)).made == ["scores"]
    assert rn.run(spark, out, **aligned(files, prep_run="other")).made == ["summary_table"]
    with open(files / "mapping" / "K1.sam", "a") as more:
        more.write("x~~umi~AAAAAAAA~~qumi~IIIIIIII\t0\tchr1\t60\t40\t4M\t*\t0\t0\tAAAA\tIIII\n")
    assert rn.run(spark, out, **aligned(files, prep_run="other")).made == ["counts", "bed", "summary_table", "scores"]


def test_run_keeps_its_hands_off_other_files(spark, files):
    (files / "out" / "prepared").mkdir(parents=True)
    (files / "out" / "prepared" / "mine.txt").write_text("x")
    with pytest.raises(FileExistsError):
        rn.run(spark, str(files / "out"), **arguments(files))
    assert (files / "out" / "prepared" / "mine.txt").read_text() == "x"


def test_run_looks_for_sites_in_a_genome(spark, files):
    sequence = bytearray(b"A" * 1000)
    for p in range(50, 1000, 100):
        sequence[p:p + 4] = b"GATC"
    (files / "genome.fa").write_bytes(b">1 dna\n" + bytes(sequence) + b"\n")
    out = str(files / "out")
    done = rn.run(spark, out, **arguments(
        files, sam=str(files / "mapping"), genome=str(files / "genome.fa"), conditions=str(files / "meta"), sizes=str(files / "sizes")))
    assert done.made == ["prepared", "sites", "counts", "bed", "summary_table", "scores"]
    assert spark.read.parquet(done.paths["sites"]).count() == 10
    with pytest.raises(ValueError, match="either the sites or the genome"):
        rn.run(spark, out, **arguments(files, sam=str(files / "mapping")))
