"""A whole run in one call: sequencer reads, alignments, configuration and condition table in; BED files, summary and scores out.

Each stage leaves its output below the run's folder and, when all of it is written, a note of what it was made from: the files with
their sizes and times, the notes of the stages before it, and the parameters. A call that finds a stage's note unchanged takes its
output as it is, so a run that lost its driver, or that waits for the aligner, goes on behind the last stage that ended; a changed
file or parameter repeats the stages that depend on it and no others.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cutgrid.functions.sizing import owned, stage
from cutgrid.operators import alignments as aln, summary as sm
from cutgrid.params import LibraryParams, ScoreParams
from cutgrid.plans.preprocess import count_sites, cut_sites, flag_reads, write_prepared
from cutgrid.plans.programs import score_files
from cutgrid.sources.fastq import read_fastq
from cutgrid.sources.sam import read_sam
from cutgrid.sources.sinks import write_site_bed, write_summary
from cutgrid.sources.tables import listed_files, read_bed, read_conditions, read_config, read_scores

NOTES = "_finished"


class Folder:
    """The files of a folder, through its own file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.system = self.hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}")

    def exists(self, name: str) -> bool:
        return self.system.exists(self._at(name))

    def delete(self, name: str) -> None:
        self.system.delete(self._at(name), True)

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        found = self.spark.read.schema("value string").text(str(self._at(name)), wholetext=True).collect()
        return found[0][0] if found else ""

    def write(self, name: str, text: str) -> None:
        """All of the text or nothing: another name until it is written."""
        passing = f"{name}.passing"
        out = self.system.create(self._at(passing), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.delete(name)
        if not self.system.rename(self._at(passing), self._at(name)):
            raise OSError(f"cannot name {self.path}/{name}")


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """URI, size and time of the files of a path, by which a change is seen."""
    hadoop, conf, found = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration(), []
    for _, uri in listed_files(spark, [path]):
        file = hadoop.Path(spark._jvm.java.net.URI(uri))
        status = file.getFileSystem(conf).getFileStatus(file)
        found.append((uri, status.getLen(), status.getModificationTime()))
    return found


class Stages:
    """Runs stages that are not finished yet. `made` names those that ran in this session."""

    def __init__(self, spark: SparkSession, out: str) -> None:
        self.spark, self.folder = spark, Folder(spark, out)
        self.digests: dict[str, str] = {}
        self.made: list[str] = []

    def __call__(self, name: str, make: Callable[[str], None], files: dict[str, str | None], after: tuple[str, ...] = (), **parameters) -> str:
        """The path of stage `name`, made by `make(path)` from the files at `files` and the stages `after`.

        An output that is there without a note of this class is somebody else's and an error.
        """
        note, begun = f"{NOTES}/{name}.json", f"{NOTES}/{name}.begun"
        made_of = {
            "files": {key: _files(self.spark, path) for key, path in files.items() if path is not None},
            "after": {key: self.digests[key] for key in after}, "parameters": parameters,
        }
        text = json.dumps(made_of, sort_keys=True, default=str)
        self.digests[name] = hashlib.sha256(text.encode()).hexdigest()
        path = f"{self.folder.path}/{name}"
        if self.folder.exists(name):
            if self.folder.read(note) == text:
                return path
            if not self.folder.exists(begun):
                raise FileExistsError(f"{path} was not made by a run")
            self.folder.delete(note)
            self.folder.delete(name)
        self.folder.write(begun, text)
        with owned(self.spark):
            make(path)
        self.folder.write(note, text)
        self.made.append(name)
        return path


@dataclass
class Run:
    """Paths of the outputs by stage, the stages that were made by this call, and what is there as tables: read_counts, sites, counts,
    stats, alignment_counts, bed, summary and scores."""

    paths: dict[str, str] = field(default_factory=dict)
    made: list[str] = field(default_factory=list)
    tables: dict[str, DataFrame] = field(default_factory=dict)


def run(
    spark: SparkSession, out: str, config: str, fastq: str, sam: str | None = None, sites: str | None = None, genome: str | None = None,
    conditions: str | None = None, sizes: str | None = None, mask: str | None = None, regions: str | None = None,
    params: LibraryParams = LibraryParams(), score_params: ScoreParams = ScoreParams(), prep_run: str = "run",
    chrom_prefix: str = "chr", level: int = 6,
) -> Run:
    """All stages that the given files allow, below `out`.

    `prepared/fastq_prefix/<library>.fastq.gz` are the reads to align. Without `sam` the run ends there; called again with it, it goes on.
    `bed/<library>.bed.gz` are the counts per cut site, which the condition table may list by path, and `summary_table` is the summary.
    Sites come from the BED `sites`, or are looked for in `genome`. With `conditions` and `sizes`, `scores` are the scores.
    """
    stages, done = Stages(spark, out), Run()

    def keep(name: str, path: str) -> str:
        done.paths[name], done.made = path, list(stages.made)
        return path

    def prepare(path: str) -> None:
        flagged = stage(flag_reads(read_fastq(spark, fastq), read_config(spark, config), params))
        sm.read_counts(flagged).write.parquet(f"{path}/read_counts")
        write_prepared(flagged, path, params, whole=True, level=level)

    def tables(folder: str, *names: str) -> None:
        done.tables |= {name: spark.read.parquet(f"{folder}/{name}") for name in names}

    prepared = keep("prepared", stages("prepared", prepare, {"config": config, "fastq": fastq}, params=asdict(params), level=level))
    tables(prepared, "read_counts")
    if sam is None:
        return done
    if (sites is None) == (genome is None):
        raise ValueError("either the sites or the genome must be given")
    before: tuple[str, ...] = ()
    if genome is not None:
        sites = keep("sites", stages(
            "sites", lambda path: cut_sites(spark, genome, params, chrom_prefix).write.parquet(path), {"genome": genome},
            cut_seq=params.cut_seq, prefix=chrom_prefix))
        before = ("sites",)
    done.tables["sites"] = spark.read.parquet(sites) if genome is not None else read_bed(spark, sites)

    def count(path: str) -> None:
        counted = count_sites(aln.umi_from_name(read_sam(spark, sam)), done.tables["sites"], params)
        for name in ("counts", "stats", "alignment_counts"):
            getattr(counted, name).write.parquet(f"{path}/{name}")
        counted.bed.write.parquet(f"{path}/bed")

    counts = keep("counts", stages(
        "counts", count, {"sam": sam, "sites": None if before else sites}, before, params=asdict(params)))

    tables(counts, "counts", "stats", "alignment_counts", "bed")

    def bed(path: str) -> None:
        write_site_bed(done.tables["bed"], path, whole=True, level=level)

    keep("bed", stages("bed", bed, {}, ("counts",), level=level))

    def summarise(path: str) -> None:
        write_summary(summary, path)

    parts = [done.tables["read_counts"], done.tables["alignment_counts"], sm.site_totals(done.tables["stats"], done.tables["counts"])]
    summary = done.tables["summary"] = sm.summarize(parts, prep_run, read_config(spark, config))
    keep("summary_table", stages("summary_table", summarise, {"config": config}, ("prepared", "counts"), prep_run=prep_run))
    if conditions is None:
        return done
    if sizes is None:
        raise ValueError("scores need the sizes of the chromosomes")
    listed = sorted({row.fpath for row in read_conditions(spark, conditions).select("fpath").collect()})

    def scores(path: str) -> None:
        domain = done.tables["sites"] if score_params.site_domain == "universe" else None
        score_files(spark, conditions, path, sizes, score_params, sites=domain, mask_bed=mask, bin_bed=regions)

    files = {"conditions": conditions, "sizes": sizes, "mask": mask, "regions": regions, "sites": None if before else sites}
    files |= {f"condition {number}": path for number, path in enumerate(listed)}
    written = keep("scores", stages("scores", scores, files, ("bed", *before), params=asdict(score_params)))
    done.tables["scores"] = read_scores(spark, written)
    return done
