"""The steps on files, one after the other, as a user runs them."""

import gzip

import pytest

from cutgrid.params import ScoreParams
from cutgrid.plans import programs as pg
from cutgrid.sources import tables as tb
from tests.test_sources import write_logs


def lines(folder):
    out = []
    for part in sorted(folder.glob("part-*")):
        out += gzip.decompress(part.read_bytes()).decode().splitlines()
    return out


def test_umi_lists_to_bed(spark, tmp_path):
    with gzip.open(tmp_path / "K1.clean.plus.umi.txt.gz", "wt") as out:
        out.write("chr1\t104\tAC\tI1\nchr1\t104\tGT\tI2\nchr1\t154\tTT\tI3\nchr9\t1\tTT\tI9\n")
    with gzip.open(tmp_path / "K1.clean.revs.umi.txt.gz", "wt") as out:
        out.write("chr1\t100\tAC\tI4\nchr1\t97\tCC\tI5\nchr1\t298\tGG\tI6\n")
    (tmp_path / "sites.bed").write_text("chr1 dna\t100\t104\ts1\nchr1 dna\t300\t304\ts2\n")
    pg.group_umis(spark, str(tmp_path / "*plus*"), str(tmp_path / "*revs*"), str(tmp_path / "grouped"), cs_len=4)
    assert lines(tmp_path / "grouped" / "libid=K1") == [
        "chr1\t97\tCC\tI5", "chr1\t100\tAC GT AC\tI1 I2 I4", "chr1\t150\tTT\tI3", "chr1\t298\tGG\tI6", "chr9\t-3\tTT\tI9",
    ]
    stats = pg.umis_to_sites(
        spark, str(tmp_path / "grouped"), str(tmp_path / "sites.bed"), str(tmp_path / "atcs"), "umis_at_cs"
    ).first()
    assert (stats.libid, stats.n_umis, stats.n_pos, stats.n_clean_umis, stats.n_sites, stats.dist_max) == ("K1", 6, 4, 5, 2, 50)
    kept = tmp_path / "atcs" / "umis_at_cs"
    assert lines(kept / "libid=K1") == ["chr1\t100\tCC AC GT AC\tI5 I1 I2 I4", "chr1\t300\tGG\tI6"]
    assert lines(tmp_path / "atcs" / "orphan.umis_at_cs" / "libid=K1") == ["chr1\t100\tTT\tI3"]
    totals = pg.deduplicate(spark, str(kept), str(tmp_path / "dedup")).first()
    assert (totals.reads, totals.removed, totals.kept) == (5, 1, 4)
    assert lines(tmp_path / "dedup" / "libid=K1") == ["chr1\t100\tCC AC GT\t3", "chr1\t300\tGG\t1"]
    pg.final_bed(spark, str(tmp_path / "dedup"), str(tmp_path / "bed"))
    assert lines(tmp_path / "bed" / "libid=K1") == ["chr1\t100\t100\tpos_1\t3", "chr1\t300\t300\tpos_2\t1"]
    with pytest.raises(Exception, match="already exists"):
        pg.final_bed(spark, str(tmp_path / "dedup"), str(tmp_path / "bed"))


def test_padded_numbers_are_read(spark, tmp_path):
    (tmp_path / "K1.dedup.txt").write_text("chr1\t    5\tAC GT\t 2\n")
    row = tb.read_dedup_umis(spark, str(tmp_path / "K1.dedup.txt")).first()
    assert tuple(row) == ("K1", "chr1", 5, ["AC", "GT"], 2)


def test_summary_of_logs(spark, tmp_path):
    root = tmp_path / "RUN7"
    (root / "fastq").mkdir(parents=True)
    for lib in ("K2", "K1"):
        write_logs(root, lib)
        (root / "fastq" / f"{lib}_S1_R1_001.fastq.gz").write_bytes(b"x")
    rows = pg.summary_of_logs(spark, str(root)).orderBy("library_id").collect()
    assert [(r.prep_run, r.library_id, r.input, r.uniq) for r in rows] == [("RUN7", "K1", 100, 30), ("RUN7", "K2", 100, 30)]
    (root / "fastq" / "K3_S1.fastq.gz").write_bytes(b"x")
    with pytest.raises(Exception, match="of library K3"):
        pg.summary_of_logs(spark, str(root)).collect()


def test_scores_of_files(spark, tmp_path):
    meta = ["exid\tcond\tlibid\tfpath"]
    for i, lib in enumerate("AB"):
        meta.append(f"E\t{i + 1}min\t{lib}\t{tmp_path}/{lib}.bed")
        (tmp_path / f"{lib}.bed").write_text("".join(f"chr1\t{p}\t{p}\tpos_{p}\t{(p * (i + 3)) % 7 + 1}\n" for p in range(0, 5_000, 50)))
    (tmp_path / "meta.tsv").write_text("\n".join(meta) + "\n")
    (tmp_path / "sizes.bed").write_text("chr1\t0\t5000\n")
    (tmp_path / "mask.tsv").write_text("chr1\t0\t1000\tp_telo\n")
    table = pg.score_files(
        spark, str(tmp_path / "meta.tsv"), str(tmp_path / "out"), str(tmp_path / "sizes.bed"),
        ScoreParams(bin_tags="1e3:5e2"), mask_bed=str(tmp_path / "mask.tsv"),
    )
    assert sorted(r.start for r in table.collect()) == list(range(1_000, 5_000, 500))
    assert (tmp_path / "out" / "exid=E" / "bin_tag=rescaled.bins_1000_500").is_dir()
