"""Domain tables derived from the general test tables, row for row in Spark and in SQL.

Integer arithmetic and plain string functions only, so both engines build identical rows. Every
derivation is a projection of a whole table: work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CUT_SEQ = "GATC"
BARCODE = "GATCGATC"
BIN_SIZE, BIN_STEP = 10_000, 1_000
_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _letter(n: Column) -> Column:
    """Letter 0..3 of the DNA alphabet."""
    return F.substring(F.lit("ACGT"), (n + 1).cast("int"), 1)


def _pick(texts: list[str], n: Column) -> Column:
    """Text number `n` of a short list made at plan time."""
    return F.get(F.array(*[F.lit(t) for t in texts]), n.cast("int"))


def _chrom(n: Column) -> Column:
    return _pick([f"chr{i}" for i in range(1, 8)], n)


def _umi() -> Column:
    return _pick(["AAAAAA" + a + b for a in "ACGT" for b in "ACGT"], F.col("l_partkey") % 16)


def _umi_qual() -> Column:
    """Character i of 8 is 55 + (7 * part + i * supplier) % 19, looked up by both remainders."""
    texts = ["".join(chr(55 + (a + b * i) % 19) for i in range(1, 9)) for a in range(19) for b in range(19)]
    return _pick(texts, F.col("l_partkey") * 7 % 19 * 19 + F.col("l_suppkey") % 19)


def _read_id() -> Column:
    return F.concat_ws(":", *[F.col(c).cast("string") for c in _KEYS])


def _raw_pos() -> Column:
    return F.col("l_orderkey") * 20 + F.col("l_linenumber") * 3


_QUAL_SQL = " || ".join(f"chr(CAST(55 + (l_partkey * 7 + l_suppkey * {i}) % 19 AS INTEGER))" for i in range(1, 9))
_RAW_SQL = f"""reads_raw AS (
  SELECT l_returnflag AS libid, 'chr' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS chrom,
         l_orderkey * 20 + l_linenumber * 3 AS pos,
         CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand,
         'AAAAAA' || substr('ACGT', 1 + (l_partkey % 16) // 4, 1) || substr('ACGT', 1 + l_partkey % 4, 1) AS umi,
         {_QUAL_SQL} AS qual,
         concat_ws(':', {", ".join(f"CAST({c} AS VARCHAR)" for c in _KEYS)}) AS read_id,
         CAST(l_quantity AS INTEGER) AS mapq, l_linestatus, {", ".join(_KEYS)}
  FROM lineitem)"""
ORDER_SQL = "pos, strand, " + ", ".join(_KEYS)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positioned reads with UMIs, before the plus-strand shift."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("libid"),
        _chrom(F.col("l_suppkey") % 5).alias("chrom"),
        _raw_pos().alias("pos"),
        F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("+").alias("strand"),
        _umi().alias("umi"),
        _umi_qual().alias("qual"),
        F.struct(*_KEYS).alias("ord"),
    )


SHIFTED_SQL = "reads AS (SELECT * REPLACE (pos - CASE WHEN strand = '+' THEN 4 ELSE 0 END AS pos) FROM reads_raw)"
READS_SQL = f"{_RAW_SQL},\n{SHIFTED_SQL}"


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _chrom(F.col("o_orderkey") % 4).alias("chrom"),
        (F.col("o_orderkey") * 20 + F.col("o_custkey") % 16).alias("start"),
    ).distinct()


SITES_SQL = """sites AS (
  SELECT DISTINCT 'chr' || CAST(o_orderkey % 4 + 1 AS VARCHAR) AS chrom, o_orderkey * 20 + o_custkey % 16 AS start
  FROM orders)"""

NEAREST_SQL = """with_left AS (
  SELECT r.*, s.start AS lsite FROM reads r ASOF LEFT JOIN sites s ON r.chrom = s.chrom AND r.pos >= s.start),
with_both AS (
  SELECT l.*, s.start AS rsite FROM with_left l ASOF LEFT JOIN sites s ON l.chrom = s.chrom AND l.pos <= s.start),
placed AS (
  SELECT * EXCLUDE (lsite, rsite),
         CASE WHEN lsite IS NULL THEN rsite WHEN rsite IS NULL THEN lsite
              WHEN pos - lsite > rsite - pos THEN rsite ELSE lsite END AS site
  FROM with_both WHERE lsite IS NOT NULL OR rsite IS NOT NULL),
assigned AS (SELECT *, abs(pos - site) AS dist, abs(pos - site) > 20 AS is_orphan FROM placed)"""
ASSIGNED_SQL = f"{READS_SQL},\n{SITES_SQL},\n{NEAREST_SQL}"

UNIQUE_SQL = """counts AS (
  SELECT libid, chrom, site, CAST(count(*) AS BIGINT) AS pre_n, CAST(count(DISTINCT umi) AS BIGINT) AS counts
  FROM assigned WHERE NOT is_orphan GROUP BY libid, chrom, site)"""
COUNTS_SQL = f"{ASSIGNED_SQL},\n{UNIQUE_SQL}"


def raw_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequencer reads: prefix of UMI, barcode and cut site, then an insert of varying length."""
    bc = F.concat(F.lit("GATCGAT"), _letter(F.col("l_partkey") % 4))
    cs = F.concat(F.lit("GA"), _letter(F.col("l_suppkey") % 4), _letter(F.col("l_orderkey") % 4))
    insert = F.concat(
        F.when(F.col("l_linestatus") == "O", "G").otherwise("T"), F.lit("ACGTTGCAACG"),
        F.repeat(_letter(F.col("l_suppkey") % 4), F.col("l_linenumber")),
    )
    tail = F.repeat(F.char(F.lit(53) + F.col("l_partkey") % 20), F.col("l_linenumber") + 24)
    row = F.struct(
        F.col("l_returnflag").alias("libid"), _read_id().alias("read_id"),
        F.concat(_umi(), bc, cs, insert).alias("seq"), F.concat(_umi_qual(), tail).alias("qual"),
    )
    # As rows of a generator the texts are made once per read, like columns of a file; otherwise every
    # use of a column in a filter would repeat the expression that makes it.
    return table(spark, sf_dir, "lineitem").select(F.inline(F.array(row)))


RAW_READS_SQL = _RAW_SQL + """,
raw_reads AS (
  SELECT libid, read_id,
         umi || 'GATCGAT' || substr('ACGT', 1 + l_partkey % 4, 1)
         || 'GA' || substr('ACGT', 1 + l_suppkey % 4, 1) || substr('ACGT', 1 + l_orderkey % 4, 1)
         || CASE WHEN l_linestatus = 'O' THEN 'G' ELSE 'T' END || 'ACGTTGCAACG'
         || repeat(substr('ACGT', 1 + l_suppkey % 4, 1), l_linenumber) AS seq,
         qual || repeat(chr(CAST(53 + l_partkey % 20 AS INTEGER)), l_linenumber + 24) AS qual
  FROM reads_raw)"""


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected barcode per library: all libraries of the reads share one."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("libid"), F.lit(BARCODE).alias("barcode")
    ).distinct()


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned reads; `multi` marks reads for which the aligner saw more than one place."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    flag = (
        F.when(line % 2 == 0, 16).otherwise(0) + F.when(part % 11 == 0, 4).otherwise(0)
        + F.when(part % 13 == 0, 256).otherwise(0)
    )
    cigar = F.concat(
        (line + 20).cast("string"), F.lit("M"), (part % 3 + 1).cast("string"),
        F.when(part % 2 == 0, "I").otherwise("D"), F.lit("10M"), (supp % 4 + 1).cast("string"), F.lit("S"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("libid"), _read_id().alias("read_id"), flag.alias("flag"),
        F.when(supp % 7 == 0, "chrM").otherwise(_chrom(supp % 5)).alias("chrom"),
        _raw_pos().alias("pos"), F.col("l_quantity").cast("int").alias("mapq"), cigar.alias("cigar"),
        F.lit("*").alias("rnext"), (part % 17 == 0).alias("multi"),
        _umi().alias("umi"), _umi_qual().alias("umi_qual"), F.struct(*_KEYS).alias("ord"),
    )


ALIGNED_SQL = """alignments AS (
  SELECT libid, read_id,
         CASE WHEN l_linenumber % 2 = 0 THEN 16 ELSE 0 END + CASE WHEN l_partkey % 11 = 0 THEN 4 ELSE 0 END
         + CASE WHEN l_partkey % 13 = 0 THEN 256 ELSE 0 END AS flag,
         CASE WHEN l_suppkey % 7 = 0 THEN 'chrM' ELSE chrom END AS chrom, pos, mapq,
         CAST(l_linenumber + 20 AS VARCHAR) || 'M' || CAST(l_partkey % 3 + 1 AS VARCHAR)
         || CASE WHEN l_partkey % 2 = 0 THEN 'I' ELSE 'D' END || '10M' || CAST(l_suppkey % 4 + 1 AS VARCHAR) || 'S' AS cigar,
         l_partkey % 17 = 0 AS multi, umi, qual AS umi_qual
  FROM reads_raw)"""
ALIGNMENTS_SQL = f"{_RAW_SQL},\n{ALIGNED_SQL}"


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked regions, overlapping on purpose: two behind the first order of every 2,000 keys."""
    block = F.floor(F.col("o_orderkey") / 2000)
    first = table(spark, sf_dir, "orders").groupBy(block.alias("block")).agg((F.min("o_orderkey") * 20).alias("first"))
    rows = F.array(
        F.struct(F.col("first").alias("start"), (F.col("first") + 5000).alias("end")),
        F.struct((F.col("first") + 3000).alias("start"), (F.col("first") + 8000).alias("end")),
    )
    return first.select(_chrom(F.col("block") % 4).alias("chrom"), F.explode(rows).alias("r")).select("chrom", "r.start", "r.end")


MASK_SQL = """mask_base AS (
  SELECT 'chr' || CAST(o_orderkey // 2000 % 4 + 1 AS VARCHAR) AS chrom, min(o_orderkey) * 20 AS s FROM orders GROUP BY o_orderkey // 2000),
mask AS (
  SELECT chrom, s AS start, s + 5000 AS "end" FROM mask_base
  UNION ALL SELECT chrom, s + 3000, s + 8000 FROM mask_base)"""


def chrom_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sites(spark, sf_dir).groupBy("chrom").agg((F.max("start") + 1).alias("end"))
        .select("chrom", F.lit(0).cast("long").alias("start"), "end")
    )


SIZES_SQL = 'sizes AS (SELECT chrom, 0 AS start, max(start) + 1 AS "end" FROM sites GROUP BY chrom)'


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Custom bins of very different lengths, one behind every order, overlapping each other."""
    start = F.col("o_orderkey") * 20
    return table(spark, sf_dir, "orders").select(
        _chrom(F.col("o_orderkey") % 4).alias("chrom"), start.alias("region_start"),
        (start + 100 + F.col("o_custkey") * 13).alias("region_end"),
    ).distinct()


REGIONS_SQL = """regions AS (
  SELECT DISTINCT 'chr' || CAST(o_orderkey % 4 + 1 AS VARCHAR) AS chrom, o_orderkey * 20 AS region_start,
         o_orderkey * 20 + 100 + o_custkey * 13 AS region_end
  FROM orders)"""


def condition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site counts of three conditions of one experiment: a site is a distinct read position."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_returnflag").alias("libid"), _chrom(F.col("l_suppkey") % 4).alias("chrom"),
            _raw_pos().alias("start"),
        )
        .agg(F.count("*").alias("score"))
    )


CONDITION_COUNTS_SQL = """site_counts AS (
  SELECT l_returnflag AS libid, 'chr' || CAST(l_suppkey % 4 + 1 AS VARCHAR) AS chrom,
         l_orderkey * 20 + l_linenumber * 3 AS start, CAST(count(*) AS BIGINT) AS score
  FROM lineitem GROUP BY ALL)"""


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condition table of the experiment, weak to strong."""
    lib = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.lit("EXP1").alias("exid"), lib.alias("libid"),
        F.when(lib == "A", "20s").when(lib == "N", "1min").otherwise("2.5min").alias("cond"),
        F.when(lib == "A", 1).when(lib == "N", 2).otherwise(3).alias("cond_order"),
    ).distinct()


CONDITIONS_SQL = """conditions AS (
  SELECT DISTINCT 'EXP1' AS exid, l_returnflag AS libid,
         CASE l_returnflag WHEN 'A' THEN '20s' WHEN 'N' THEN '1min' ELSE '2.5min' END AS cond,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS cond_order
  FROM lineitem)"""


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of several tools, one log per order priority."""
    c, t, key = F.col("o_custkey"), F.col("o_orderkey") + F.col("o_custkey"), F.col("o_orderkey")
    line = (
        F.when(key % 3 == 0, F.concat(F.lit("INFO "), c.cast("string"), F.lit("/"), t.cast("string"),
                                      F.lit(" (12.50%) flag_extract.py:246")))
        .when(key % 3 == 1, F.concat(F.lit("    "), c.cast("string"), F.lit(" (3.1%) aligned 0 times")))
        .otherwise("noise")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("libid"), key.alias("line_no"), line.alias("line")
    )


LOG_LINES_SQL = """log_lines AS (
  SELECT o_orderpriority AS libid, o_orderkey AS line_no,
         CASE WHEN o_orderkey % 3 = 0 THEN 'INFO ' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey + o_custkey AS VARCHAR) || ' (12.50%) flag_extract.py:246'
              WHEN o_orderkey % 3 = 1 THEN '    ' || CAST(o_custkey AS VARCHAR) || ' (3.1%) aligned 0 times'
              ELSE 'noise' END AS line
  FROM orders)"""


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sequence chunks, one chunk per contig."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("chrom"), F.lit(0).cast("long").alias("offset"),
        F.length("text").cast("long").alias("span"), F.col("text").alias("seq"),
    )
