"""Explicit schemas of every headerless text table; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name.rstrip("_"), kind) for name, kind in fields.items()])


_S, _L = T.StringType(), T.LongType()

# One line per read and one file per strand.
STRANDED_UMIS = _struct(chrom=_S, pos=_L, seq=_S, qual=_S)
# One line per position, `seq` and `qual` hold blank-joined lists.
GROUPED_UMIS = STRANDED_UMIS
# One line per cut site, `seq` holds the blank-joined unique UMIs.
DEDUP_UMIS = _struct(chrom=_S, pos=_S, seq=_S, counts=_S)
BED3 = _struct(chrom=_S, start=_L, end=_L)
BED4 = _struct(chrom=_S, start=_L, end=_L, name=_S)
BED5 = _struct(chrom=_S, start=_L, end=_L, name=_S, score=_L)
CONFIG = _struct(libid=_S, barcode=_S)
CONDITIONS = _struct(exid=_S, cond=_S, libid=_S, fpath=_S)
FASTQ = _struct(file=_S, ordinal=_L, header=_S, seq=_S, qual=_S)
FASTA = _struct(file=_S, part=_L, ordinal=_L, contig=_S, lead=T.BooleanType(), rel_offset=_L, span=_L, seq=_S, ends=_S)

# Names and order of the columns of the per-library summary table.
SUMMARY_COLUMNS = [
    "prep_run", "library_id", "input", "umi_hq", "umi_hq%", "prefix", "prefix%",
    "unmapped", "2nd_aln", "chrM", "low_mapq", "mapped", "mapped%",
    "fromCS", "fromCS%", "uniq", "uniq%", "out%",
]
