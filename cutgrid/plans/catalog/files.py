"""Readers and writers: tables written in the text formats and read back."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cutgrid.functions.sizing import fresh_dir, stage
from cutgrid.operators import alignments as aln, bins as bn, motif as mo, reads as rd, scores as sc, summary as sm, umis as um
from cutgrid.operators.logs import log_metrics, require_metrics
from cutgrid.plans import derived as d
from cutgrid.plans.catalog.alignments import CLEAN
from cutgrid.plans.catalog.genome import MOTIF
from cutgrid.plans.catalog.reads import FLAGGED_SQL, PATTERN
from cutgrid.plans.catalog.registry import query
from cutgrid.plans.catalog.scores import (
    _TWO, _TWO_SQL, _rescaled_sql, _run_sql, _scores_sql, _show, scored, two_experiments,
)
from cutgrid.plans.catalog.summary import _SUMMARY_SQL, summary_table
from cutgrid.plans.catalog.umis import HOT_ROWS, HOT_SQL, assigned, counted, hot_reads, shifted
from cutgrid.plans.preprocess import prepare_run
from cutgrid.plans.programs import score_files
from cutgrid.sources import sinks, tables as tb
from cutgrid.sources.fasta import read_fasta
from cutgrid.sources.fastq import read_fastq
from cutgrid.sources.sam import read_sam

FROM_FOLDER = "libid=([^/]+)"


@query(f"WITH {d.RAW_READS_SQL} SELECT libid, read_id, seq, qual FROM raw_reads")
def fastq_scan(spark, sf_dir):
    """Plain FASTQ as the writer leaves it, a folder per library, read in byte ranges."""
    out = fresh_dir(spark, "fastq")
    sinks.write_reads(d.raw_reads(spark, sf_dir), out, compress=False)
    return read_fastq(spark, out).select("libid", "read_id", "seq", "qual")


@query(f"WITH {d.RAW_READS_SQL} SELECT read_id, seq, qual FROM raw_reads")
def fastq_gzip_scan(spark, sf_dir):
    out = fresh_dir(spark, "fastq-gz")
    sinks.write_reads(d.raw_reads(spark, sf_dir).drop("libid"), out)
    return read_fastq(spark, out, partitions=8).select("read_id", "seq", "qual")


@query(f"""WITH {FLAGGED_SQL}
SELECT CASE WHEN NOT good THEN 'lq' WHEN prefix_ok THEN 'prefix' ELSE 'prefix_unmatched' END AS status, libid, CAST(count(*) AS BIGINT) AS n
FROM judged GROUP BY ALL""")
def run_rejects(spark, sf_dir):
    """First half of a run on files: FASTQ and configuration in, reads to align and every group of rejects out, counted."""
    out = fresh_dir(spark, "prepared")
    sinks.write_reads(d.raw_reads(spark, sf_dir), f"{out}/fastq", compress=False)
    sinks.write_tsv(d.config(spark, sf_dir).select("libid", "barcode"), f"{out}/config")
    prepare_run(spark, f"{out}/config", f"{out}/fastq", out)
    aligned = read_fastq(spark, f"{out}/fastq_prefix").select("libid", F.lit("prefix").alias("status"))
    rejected = spark.read.text(f"{out}/fastq_rejected").filter(F.col("value").startswith("@") & F.col("value").contains(":"))
    return aligned.unionByName(rejected.select("libid", "status")).groupBy("status", "libid").agg(F.count("*").alias("n"))


@query(f"""WITH {FLAGGED_SQL}
SELECT CASE WHEN good THEN 'hq' ELSE 'lq' END AS status, libid, CAST(count(*) AS BIGINT) AS n FROM judged GROUP BY ALL""")
def rejects_export(spark, sf_dir):
    """Reads written per library and status, and counted from the written files."""
    out = fresh_dir(spark, "rejects")
    flagged = rd.flag_status(rd.extract_flags(d.raw_reads(spark, sf_dir), PATTERN))
    sinks.write_reads(flagged, out, PATTERN)
    lines = spark.read.text(out)
    return lines.filter(F.col("value").contains("~~umi~")).groupBy("status", "libid").agg(F.count("*").alias("n"))


_ASCII_SQL = "documents_ascii AS (SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', 'N', 'g')) AS text FROM documents)"


@query(f"""WITH {_ASCII_SQL},
starts AS (SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, unnest(range(0, length(text) - 1)) AS start, text FROM documents_ascii)
SELECT chrom, start, start + 2 AS "end" FROM starts WHERE lower(substr(text, start + 1, 2)) = '{MOTIF}'""")
def fasta_sites(spark, sf_dir):
    """Documents as FASTA lines of 60 letters, read in byte ranges and searched."""
    return mo.find_motif(read_fasta(spark, _fasta(spark, sf_dir)), MOTIF)


def _fasta(spark, sf_dir) -> str:
    """Documents as contigs of a FASTA file, a letter for each character."""
    out = fresh_dir(spark, "fasta")
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", "N"))
    wrapped = F.regexp_replace(letters, "(.{60})", "$1\n")
    record = F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" dna\n"), wrapped)
    d.table(spark, sf_dir, "documents").select(record.alias("value")).write.text(out)
    return out


@query(f"""WITH {_ASCII_SQL},
wanted AS (SELECT substr(text, 101, 80) AS motif FROM documents_ascii WHERE length(text) >= 200 ORDER BY doc_id LIMIT 1),
starts AS (SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, unnest(range(0, length(text) - 79)) AS start, text FROM documents_ascii
           WHERE contains(text, (SELECT motif FROM wanted)))
SELECT chrom, start, start + 80 AS "end" FROM starts WHERE substr(text, start + 1, 80) = (SELECT motif FROM wanted)""")
def long_motif_sites(spark, sf_dir):
    """A motif of 80 letters, looked for in chunks of 64 that overlap by 79."""
    text = F.upper(F.regexp_replace("text", "[^A-Za-z]", "N"))
    long = d.table(spark, sf_dir, "documents").filter(F.length("text") >= 200)
    motif = long.orderBy("doc_id").select(F.substring(text, 101, 80).alias("motif")).first()["motif"]
    return mo.find_motif(read_fasta(spark, _fasta(spark, sf_dir), chunk=64, overlap=len(motif) - 1), motif)


_SAM_COLUMNS = ("read_id", "flag", "chrom", "pos", "mapq", "cigar", "multi")


@query(f"WITH {d.ALIGNMENTS_SQL} SELECT {', '.join(_SAM_COLUMNS)} FROM alignments WHERE {CLEAN}")
def sam_scan(spark, sf_dir):
    """Alignments as SAM text with header lines, read and filtered."""
    out = fresh_dir(spark, "sam")
    rows = d.alignments(spark, sf_dir)
    tag = F.when(F.col("multi"), "AS:i:0\tXS:i:-5").otherwise("AS:i:0")
    line = F.concat_ws(
        "\t", "read_id", F.col("flag").cast("string"), "chrom", F.col("pos").cast("string"),
        F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), tag,
    )
    header = rows.select(F.concat(F.lit("@SQ\tSN:"), F.col("chrom")).alias("value")).distinct()
    header.unionByName(rows.select(line.alias("value"))).write.text(out)
    return aln.filter_alignments(read_sam(spark, out)).select(*_SAM_COLUMNS)


@query(f"""WITH {d.READS_SQL}
SELECT libid, chrom, pos, CAST(count(*) AS BIGINT) AS n, string_agg(umi, ' ' ORDER BY strand, umi) AS umis FROM reads GROUP BY libid, chrom, pos""")
def stranded_umis_scan(spark, sf_dir):
    """One UMI list per strand written, both read, shifted and grouped."""
    out = fresh_dir(spark, "stranded")
    rows = d.reads(spark, sf_dir)
    for strand, name in (("+", "plus"), ("-", "revs")):
        lines = rows.filter(F.col("strand") == strand).select("libid", "chrom", "pos", "umi", "qual")
        sinks.write_tsv(lines, f"{out}/{name}", partition_by=["libid"])
    long = tb.read_stranded_umis(spark, f"{out}/plus", f"{out}/revs")
    grouped = um.group_positions(um.shift_plus(long, len(d.CUT_SEQ)))
    # The files give no order within a strand, so UMIs are compared as sorted per strand.
    plus = F.col("strands_plus")
    counted = um.shift_plus(long, len(d.CUT_SEQ)).groupBy("libid", "chrom", "pos").agg(F.count_if(F.col("strand") == "+").alias("strands_plus"))
    return grouped.join(counted, ["libid", "chrom", "pos"]).select("libid", "chrom", "pos", "n", F.array_join(F.concat(
        F.sort_array(F.slice("umi", F.lit(1), plus.cast("int"))),
        F.sort_array(F.slice("umi", (plus + 1).cast("int"), (F.col("n") - plus).cast("int"))),
    ), " ").alias("umis"))


@query(f"WITH {d.READS_SQL} SELECT libid, chrom, pos, umi, qual FROM reads")
def grouped_umis_scan(spark, sf_dir):
    """Grouped lists written as text, read and unrolled into reads again."""
    out = fresh_dir(spark, "grouped")
    sinks.write_grouped(um.group_positions(shifted(spark, sf_dir)), out)
    return tb.read_grouped_umis(spark, out).drop("ord", "strand")


@query(f"""WITH {d.ASSIGNED_SQL}
SELECT libid, is_orphan, CAST(count(*) AS BIGINT) AS n, CAST(sum(site) AS BIGINT) AS positions FROM assigned GROUP BY libid, is_orphan""")
def assigned_export(spark, sf_dir):
    """Kept and orphan UMIs written side by side, and counted from the written files."""
    out = fresh_dir(spark, "assigned")
    placed = stage(assigned(spark, sf_dir))
    sinks.write_assigned(um.merge_sites(placed), um.orphan_groups(placed), out, "umis_at_cs")

    def counted_lines(name: str, orphan: bool):
        lines = tb.read_tsv(spark, f"{out}/{name}", tb.schemas.GROUPED_UMIS).select(
            tb.file_library().alias("libid"), "pos", F.size(F.split("seq", " ")).alias("k")
        )
        return lines.groupBy("libid").agg(
            F.sum("k").alias("n"), F.sum(F.col("pos") * F.col("k")).alias("positions")
        ).withColumn("is_orphan", F.lit(orphan))

    return counted_lines("umis_at_cs", False).unionByName(counted_lines("orphan.umis_at_cs", True))


@query(f"""WITH {HOT_SQL}
SELECT libid, chrom, pos, CAST(count(*) AS BIGINT) AS n, md5(string_agg(umi, ' ' ORDER BY strand, {", ".join(d._KEYS)})) AS umis
FROM hot GROUP BY libid, chrom, pos""")
def hot_position_export(spark, sf_dir):
    """A position with a third of all reads is one line of the text export."""
    out = fresh_dir(spark, "hot")
    sinks.write_grouped(um.group_positions(hot_reads(spark, sf_dir), max_rows=HOT_ROWS), out)
    rows = tb.read_tsv(spark, out, tb.schemas.GROUPED_UMIS)
    return rows.select(
        tb.file_library().alias("libid"), "chrom", "pos", F.size(F.split("seq", " ")).cast("long").alias("n"), F.md5("seq").alias("umis")
    )


@query(f"WITH {d.COUNTS_SQL} SELECT libid, chrom, site AS pos, counts FROM counts")
def dedup_export(spark, sf_dir):
    """Deduplicated sites written and read back; the count must be the length of the list."""
    out = fresh_dir(spark, "dedup")
    sinks.write_dedup(um.dedup_lists(assigned(spark, sf_dir)), out)
    rows = tb.read_dedup_umis(spark, out)
    return rows.filter(F.size("umis") == F.col("counts")).drop("umis")


@query(f"""WITH {d.COUNTS_SQL}
SELECT chrom, site AS start, site AS "end", 'pos_' || CAST(row_number() OVER (PARTITION BY libid ORDER BY chrom, site) AS VARCHAR) AS name,
       counts AS score FROM counts""")
def bed_export(spark, sf_dir):
    out = fresh_dir(spark, "bed")
    sinks.write_site_bed(um.site_bed(counted(spark, sf_dir)), out)
    return tb.read_bed(spark, out, columns=5).select("chrom", "start", "end", "name", "score")


@query(f"""WITH {d.SITES_SQL} SELECT chrom, start, start + 4 AS "end", chrom || '_' || CAST(start AS VARCHAR) AS name FROM sites""")
def site_bed_scan(spark, sf_dir):
    """Site list whose chromosome names carry further words."""
    out = fresh_dir(spark, "sites")
    rows = d.sites(spark, sf_dir).select(
        F.concat("chrom", F.lit(" dna:chromosome")).alias("chrom"), "start", F.col("start") + 4,
        F.concat("chrom", F.lit("_"), F.col("start").cast("string")),
    )
    sinks.write_tsv(rows, out)
    return tb.read_bed(spark, out)


@query(f"""SELECT DISTINCT l_returnflag AS libid, '{d.BARCODE}' AS barcode FROM lineitem""")
def config_scan(spark, sf_dir):
    """Run configuration with a trailing tab on every line."""
    out = fresh_dir(spark, "config")
    d.config(spark, sf_dir).select(F.concat("libid", F.lit("\t"), "barcode", F.lit("\t")).alias("value")).write.text(out)
    return tb.read_config(spark, out)


def _condition_files(spark, sf_dir, out: str, conditions) -> str:
    """BED files as the BED writer leaves them, and a condition table that lists their folders; its path."""
    counts = d.condition_counts(spark, sf_dir).select("libid", "chrom", F.col("start").alias("site"), F.col("score").alias("counts"))
    sinks.write_site_bed(um.site_bed(counts), f"{out}/bed files")
    lines = conditions.select(
        "libid", F.concat(F.lit(f"{out}/bed files/libid="), "libid").alias("path"), "exid", "cond", "cond_order"
    )
    sinks.write_tsv(lines.coalesce(1).sortWithinPartitions("exid", "cond_order").drop("cond_order"), f"{out}/meta", compress=False, header=True)
    return f"{out}/meta"


@query(f"""WITH {d.CONDITION_COUNTS_SQL}, {d.CONDITIONS_SQL}
SELECT exid, cond, cond_order, libid, chrom, start, score FROM site_counts JOIN conditions USING (libid)""")
def condition_files_scan(spark, sf_dir):
    """A folder per condition, listed in a condition table in order of strength, with its columns in another order."""
    conditions = tb.read_conditions(spark, _condition_files(spark, sf_dir, fresh_dir(spark, "conditions"), d.conditions(spark, sf_dir)))
    return bn.with_conditions(tb.read_condition_counts(spark, conditions), conditions)


def _written_scores(spark, path: str):
    return _show(tb.read_scores(spark, path))


@query(f"WITH {_run_sql(_TWO, conditions=_TWO_SQL)}")
def scored_files(spark, sf_dir):
    """The score stage on files: BED folders, condition table, sizes and mask in, score files out and read back."""
    out = fresh_dir(spark, "score files")
    meta = _condition_files(spark, sf_dir, out, two_experiments(spark, sf_dir))
    sinks.write_tsv(d.chrom_sizes(spark, sf_dir).select("chrom", "start", "end"), f"{out}/sizes")
    sinks.write_tsv(d.mask(spark, sf_dir).select("chrom", "start", "end", F.lit("m").alias("name")), f"{out}/mask")
    score_files(spark, meta, f"{out}/scores", f"{out}/sizes", _TWO, mask_bed=f"{out}/mask")
    return _written_scores(spark, f"{out}/scores")


def _named(spark, folder: str, target: str, name) -> None:
    """Move the files of `libid=` folders to `target`, called `name(library, number)`, as a run would lay them out."""
    system = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(path(target))
    seen: dict[str, int] = {}
    for _, uri in tb.listed_files(spark, [folder]):
        library = re.search(FROM_FOLDER, uri)[1]
        seen[library] = seen.get(library, 0) + 1
        system.rename(path(uri), path(f"{target}/{name(library, seen[library])}"))


@query("SELECT l_returnflag AS libid, count(*) AS reads FROM lineitem GROUP BY l_returnflag")
def library_files(spark, sf_dir):
    """Files of a run and the library each belongs to by its name; their reads are counted."""
    out = fresh_dir(spark, "library-files")
    sinks.write_reads(d.raw_reads(spark, sf_dir), f"{out}/written", compress=False)
    _named(spark, f"{out}/written", f"{out}/fastq", lambda library, n: f"{library}_S1_{n:03d}.fastq")
    files = tb.library_files(spark, f"{out}/fastq/*", "_").select(F.substring_index("path", "/", -1).alias("file"), "libid")
    lines = spark.read.text(f"{out}/fastq").groupBy(F.col("_metadata.file_name").alias("file")).agg((F.count("*") / 4).cast("long").alias("n"))
    return files.join(lines, "file").groupBy("libid").agg(F.sum("n").alias("reads"))


@query(f"""WITH {_SUMMARY_SQL} SELECT * REPLACE ({", ".join(f"printf('%.2f%%', {chr(34)}{c}{chr(34)}) AS {chr(34)}{c}{chr(34)}" for c in sm.RATIOS)}) FROM summary""")
def summary_export(spark, sf_dir):
    """Summary written with a header and read back."""
    out = fresh_dir(spark, "summary")
    table = summary_table(spark, sf_dir)
    sinks.write_summary(table, out)
    texts = set(sm.RATIOS) | {"prep_run", "library_id"}
    schema = ", ".join(f"`{c}` {'string' if c in texts else 'long'}" for c in table.columns)
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(out)


@query(f"WITH {_scores_sql()}, {_rescaled_sql(False)}")
def score_export(spark, sf_dir):
    """Rescaled scores written per experiment and bin tag, and read back from the written files."""
    out = fresh_dir(spark, "scores")
    sinks.write_scores(sc.rescale_scores(stage(scored(spark, sf_dir))), out)
    return _written_scores(spark, out)


_LOG_SUMMARY_SQL = f"""{_SUMMARY_SQL}
SELECT * REPLACE ({", ".join(f"printf('%.2f%%', {chr(34)}{c}{chr(34)}) AS {chr(34)}{c}{chr(34)}" for c in sm.RATIOS)}) FROM summary"""


@query(f"WITH {_LOG_SUMMARY_SQL}")
def log_summary(spark, sf_dir):
    """Stage logs of every library written as text files, parsed and assembled to the summary."""
    out = fresh_dir(spark, "logs")
    t = stage(sm.as_text(summary_table(spark, sf_dir)))
    pct = lambda c: F.regexp_replace(F.col(f"`{c}`"), "%", "")
    texts = {
        "quality": F.format_string("x\nINFO 1/2 (50%%) flag_extract.py:246\nINFO %d/%d (%s%%) reads flag_extract.py:246",
                                   "umi_hq", "input", pct("umi_hq%")),
        "prefix": F.format_string("INFO %d/%d (%s%%) reads flag_regex.py:156", "prefix", "umi_hq", pct("prefix%")),
        "mapping": F.format_string("  %d (1.0%%) aligned 0 times\n  3 (1%%) aligned exactly 1 time\n  %d (2.0%%) aligned >1 times",
                                   "unmapped", F.col("`2nd_aln`")),
        "chrM": F.col("chrM").cast("string"), "low_mapq": F.col("low_mapq").cast("string"),
        "clean": F.col("mapped").cast("string"),
        "site": F.format_string("INFO Output: %d (%s%%) UMI sequences over 7 (1%%) locations", "fromCS", pct("fromCS%")),
        "dedup": F.format_string("9 non-orphan reads.\n%d UMIs left after deduplication.", "uniq"),
    }
    for key, text in texts.items():
        folder, suffix = tb.LOG_FILES[key]
        t.select(F.col("library_id").alias("libid"), text.alias("value")).write.partitionBy("libid").text(f"{out}/written/{key}")
        _named(spark, f"{out}/written/{key}", f"{out}/{folder}", lambda library, n, suffix=suffix: f"{library}{suffix}")
    lines = tb.read_logs(spark, out)
    return sm.summary_from_logs(require_metrics(log_metrics(lines)), "RUN1")


