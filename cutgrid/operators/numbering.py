"""Row numbers over a whole sorted table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cutgrid.functions.sizing import small, stage
from cutgrid.operators.intervals import BLOCK, cell_of


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`rows` with their exact 0-based `rank` by `order` within `keys`, and the size `n` of the group.

    Rows are range-partitioned by group and order; a rank is the place within the partition's part of the group plus the
    sizes of its earlier parts, so it does not depend on where the partitions were cut, and no task holds a group.
    Rows that tie in `order` are ranked in any order. `rows` is read twice: stage an expensive one first.
    """
    cut = stage(rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy(*keys, "_part").agg(F.count("*").alias("_rows")).select(
        *keys, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n")
    )
    here = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    return cut.withColumn("_here", here).join(small(parts), [*keys, "_part"]).withColumn(
        "rank", F.col("_before") + F.col("_here") - 1
    ).drop("_part", "_here", "_before")


def _before_each_block(blocks: DataFrame, chrom: str) -> DataFrame:
    """Rows before each block over all chromosomes: in order within range partitions, whose sums are few and go by value."""
    cut = stage(blocks.repartitionByRange(chrom, "_block").withColumn("_part", F.spark_partition_id()))
    sums = {row["_part"]: row["n"] for row in cut.groupBy("_part").agg(F.sum("_n").alias("n")).collect()}
    total, base = 0, []
    for part in range(max(sums, default=-1) + 1):
        base.append(total)
        total += sums.get(part, 0)
    here = Window.partitionBy("_part").orderBy(chrom, "_block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.get(F.array(*map(F.lit, base)) if base else F.array().cast("array<bigint>"), F.col("_part"))
    return cut.withColumn("_before", F.coalesce(F.sum("_n").over(here), F.lit(0)) + start).drop("_n", "_part")


def number_rows(
    df: DataFrame, name: str = "row", by: Sequence[str] = (), chrom: str = "chrom", pos: str = "start",
    width: int = BLOCK,
) -> DataFrame:
    """1-based row number in (chromosome as text, position) order, restarted per `by`.

    Rows are numbered inside blocks of positions; only the block counts (chromosome length over `width` rows) are
    accumulated in order: per `by`, or without it over range partitions of them. `df` is read twice: stage an expensive
    one first.
    """
    cut = df.withColumn("_block", cell_of(pos, width))
    blocks = cut.groupBy(*by, chrom, "_block").agg(F.count("*").alias("_n"))
    if by:
        earlier = Window.partitionBy(*by).orderBy(chrom, "_block").rowsBetween(Window.unboundedPreceding, -1)
        before = blocks.withColumn("_before", F.sum("_n").over(earlier)).drop("_n")
    else:
        before = _before_each_block(blocks, chrom)
    inside = Window.partitionBy(*by, chrom, "_block").orderBy(pos)
    return (
        cut.withColumn("_here", F.row_number().over(inside))
        .join(before, [*by, chrom, "_block"])
        .withColumn(name, F.col("_here") + F.coalesce("_before", F.lit(0)))
        .drop("_block", "_here", "_before")
    )
