"""Positions and intervals along chromosomes.

No operator here compares all rows of a chromosome with each other, and no window covers a whole
chromosome of rows. Coordinates are cut into blocks; a window runs inside one block over rows that
are distinct in their coordinate (so a block never holds more rows than it is wide), and a summary
with one row per block carries what is needed across block borders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cutgrid.functions.sizing import broadcast_limit, join_hint, measured, small, stage

BLOCK = 1 << 20
CELL = 1 << 14
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def cell_of(position: Column | str, width: int) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / F.lit(width)).cast("long") if width & (width - 1) else F.shiftright(
        position.cast("long"), width.bit_length() - 1
    )


def running(
    df: DataFrame, by: Sequence[str], on: str, values: dict[str, Column], how: str, inclusive: bool = True,
    width: int = BLOCK,
) -> DataFrame:
    """Add running sums or maxima of `values` in order of `on` within `by`.

    Rows must be distinct in (`by`, `on`). The window covers one block; totals of earlier blocks
    come from the block summary. `df` is read twice.
    """
    total = {"sum": F.sum, "max": F.max}[how]
    cut = df.withColumns({f"_v_{n}": v for n, v in values.items()} | {"_block": cell_of(on, width)})
    inside = Window.partitionBy(*by, "_block").orderBy(on).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy(*by, "_block").agg(*[total(f"_v_{n}").alias(f"_t_{n}") for n in values])
    carried = blocks.select(*by, "_block", *[total(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in values])
    here = cut.withColumns({f"_h_{n}": total(f"_v_{n}").over(inside) for n in values}).join(carried, [*by, "_block"])

    def merged(n: str) -> Column:
        if how == "max":
            return F.greatest(f"_h_{n}", f"_c_{n}")
        return F.coalesce(f"_h_{n}", F.lit(0)) + F.coalesce(f"_c_{n}", F.lit(0))

    helpers = ["_block"] + [f"_{k}_{n}" for k in "vhc" for n in values]
    return here.withColumns({n: merged(n) for n in values}).drop(*helpers)


def neighbours(sites: DataFrame, by: str = "chrom", on: str = "site") -> DataFrame:
    """Add the previous and the next distinct site of every site (null at the ends)."""
    cut = sites.select(by, on).distinct().withColumn("_block", cell_of(on, BLOCK))
    ends = cut.groupBy(by, "_block").agg(F.min(on).alias("_lo"), F.max(on).alias("_hi"))
    blocks = Window.partitionBy(by).orderBy("_block")
    ends = ends.select(
        by, "_block", F.lag("_hi").over(blocks).alias("_before"), F.lead("_lo").over(blocks).alias("_after")
    )
    inside = Window.partitionBy(by, "_block").orderBy(on)
    return (
        cut.withColumn("previous", F.lag(on).over(inside))
        .withColumn("next", F.lead(on).over(inside))
        .join(ends, [by, "_block"])
        .select(
            by, on, F.coalesce("previous", "_before").alias("previous"), F.coalesce("next", "_after").alias("next")
        )
    )


@dataclass(frozen=True)
class SiteIndex:
    """Cut sites prepared for nearest-site look-up.

    `cells` has one row per (chromosome, cell of `CELL` bases): the sorted ends of the stretches of positions that share
    a nearest site, and these sites. A cell has as many positions as it is wide, so that bounds its lists. `bounds` holds
    the first and last cell of every chromosome that has sites. Both are staged.
    """

    cells: DataFrame
    bounds: DataFrame
    fits_broadcast: bool


def index_sites(
    sites: DataFrame, chrom: str = "chrom", start: str = "start", max_bytes: int | None = None
) -> SiteIndex:
    """Build the look-up table of `nearest`.

    It is made once, staged and measured: broadcast up to `max_bytes` (by default the session's limit), shuffled above.
    """
    points = sites.select(F.col(chrom).alias("chrom"), F.col(start).cast("long").alias("site"))
    first, last = F.col("previous").isNull(), F.col("next").isNull()
    lo = F.when(first, F.lit(_FIRST)).otherwise(F.shiftright(F.col("previous") + F.col("site"), 1) + 1)
    hi = F.when(last, F.lit(_LAST)).otherwise(F.shiftright(F.col("site") + F.col("next"), 1))
    covered = F.sequence(
        cell_of(F.when(first, F.col("site")).otherwise(F.col("lo")), CELL),
        cell_of(F.when(last, F.col("site")).otherwise(F.col("hi")), CELL),
    )
    stretches = neighbours(points).withColumn("lo", lo).withColumn("hi", hi).filter("lo <= hi")
    cells = stretches.select("chrom", F.explode(covered).alias("cell"), "hi", "site").groupBy("chrom", "cell").agg(
        F.sort_array(F.collect_list(F.struct("hi", "site"))).alias("_s")
    ).select("chrom", "cell", F.col("_s.hi").alias("ends"), F.col("_s.site").alias("sites"))
    cells, _, size = measured(cells)
    bounds = cells.groupBy("chrom").agg(F.min("cell").alias("first_cell"), F.max("cell").alias("last_cell"))
    fits = size <= (broadcast_limit(sites.sparkSession) if max_bytes is None else max_bytes)
    return SiteIndex(
        cells=F.broadcast(cells) if fits else cells.hint("shuffle_hash"), bounds=small(bounds), fits_broadcast=fits
    )


def _placed(rows: DataFrame, pos: str) -> DataFrame:
    """Add `_low`, how many of the sorted `ends` lie before `pos`, by halving: a cell's list is no longer than the cell is wide, so the steps
    are known beforehand, and each is a plain column."""
    rows = rows.withColumn("_low", F.lit(0))
    for step in (1 << i for i in reversed(range(CELL.bit_length()))):
        beyond = F.get("ends", F.col("_low") + (step - 1)) < F.col(pos)
        rows = rows.withColumn("_low", F.col("_low") + F.when(beyond, step).otherwise(0))
    return rows


def nearest(points: DataFrame, index: SiteIndex, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    """Add the nearest `site` and its distance `dist`; a tie goes to the lower site.

    Points on chromosomes without sites are not in the result. Every point meets exactly one row of the index, so the
    join keeps the row count however dense the sites are; the site is found in the row's sorted lists. The join is an
    equality on (chromosome, cell); a hot cell is split by adaptive execution when it shuffles.
    """
    bounds = index.bounds.withColumnRenamed("chrom", chrom)
    cells = index.cells.withColumnRenamed("chrom", chrom)
    own_cell = F.greatest(F.least(cell_of(pos, CELL), F.col("last_cell")), F.col("first_cell"))
    met = points.join(bounds, chrom).withColumn("cell", own_cell).drop("first_cell", "last_cell").join(cells, [chrom, "cell"])
    # As a row of a generator, which no predicate passes: one on the site or its distance would be moved in front of the steps otherwise,
    # and each step, written out twice in the next, would double the plan.
    found = _placed(met, pos).withColumn("_found", F.explode(F.array(F.struct(F.get("sites", F.col("_low")).alias("site")))))
    return (
        found.withColumn("site", F.col("_found.site"))
        .withColumn("dist", F.abs(F.col(pos) - F.col("site")))
        .drop("cell", "ends", "sites", "_low", "_found")
    )


def merge_intervals(intervals: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Union of half-open intervals: overlapping and touching ones become one."""
    longest = (
        intervals.filter("end > start").groupBy(F.col(chrom).alias("chrom"), "start")
        .agg(F.max("end").alias("end"))
    )
    reach = running(longest, ["chrom"], "start", {"reach": F.col("end")}, "max", inclusive=False)
    opens = F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach")), F.col("start"))
    island = running(reach, ["chrom"], "start", {"island": opens}, "max")
    return island.groupBy("chrom", F.col("island").alias("start")).agg(F.max("end").alias("end"))


def cells_covered(intervals: DataFrame, start: str = "start", end: str = "end", width: int = CELL) -> DataFrame:
    """One row per cell that a half-open interval touches."""
    return intervals.filter(F.col(end) > F.col(start)).withColumn(
        "cell", F.explode(F.sequence(cell_of(start, width), cell_of(F.col(end) - 1, width)))
    )


def totals_below(
    points: DataFrame, edges: DataFrame, by: Sequence[str], pos: str, values: Sequence[str], chrom: str = "chrom"
) -> DataFrame:
    """Totals of `values` over all points that lie before each edge, per `by` and chromosome.

    Points and edges are put on one line of distinct positions, and a running sum along it answers
    every edge: linear in both, where joining points to the regions that hold them would make a row
    for each pair. `edges` has the chromosome and `edge`.
    """
    keys = [*by, chrom]
    line = points.select(*keys, F.col(pos).alias("edge"), *values, F.lit(0).alias("_asked"))
    known = points.select(*keys).distinct()
    asked = edges.select(chrom, "edge").distinct().join(known, chrom).select(
        *keys, "edge", *[F.lit(0).cast("long").alias(v) for v in values], F.lit(1).alias("_asked")
    )
    line = stage(line.unionByName(asked).groupBy(*keys, "edge").agg(
        *[F.sum(v).alias(v) for v in values], F.max("_asked").alias("_asked")
    ))
    below = running(line, keys, "edge", {f"{v}_below": F.col(v) for v in values}, "sum", inclusive=False)
    return below.filter("_asked = 1").select(*keys, "edge", *[f"{v}_below" for v in values])


def outside_mask(
    points: DataFrame, mask: DataFrame, pos: str = "start", chrom: str = "chrom", width: int = CELL
) -> DataFrame:
    """Points that no masked interval holds."""
    islands = merge_intervals(mask).select(
        F.col("chrom").alias(chrom), F.col("start").alias("mask_start"), F.col("end").alias("mask_end")
    )
    grid = small(cells_covered(islands, "mask_start", "mask_end", width))
    cut = points.withColumn("cell", cell_of(pos, width))
    hit = (
        (cut[chrom] == grid[chrom]) & (cut["cell"] == grid["cell"])
        & (cut[pos] >= grid["mask_start"]) & (cut[pos] < grid["mask_end"])
    )
    return cut.join(grid, hit, "left_anti").drop("cell")


def intervals_outside_mask(intervals: DataFrame, mask: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Intervals that share no base with a masked interval.

    An interval is touched if the masked intervals that begin before its end reach beyond its start. Their furthest reach is a running
    maximum along the chromosome, so an interval of any length is one row. Intervals are staged and measured, and broadcast below the
    session's limit only; the planner cannot tell how many there are if a plan makes them.
    """
    spans, _, size = measured(intervals.filter(F.col("end") > F.col("start")).select(chrom, "start", "end").distinct())
    how = join_hint(intervals.sparkSession, size)
    masked = mask.filter(F.col("end") > F.col("start")).select(
        F.col("chrom").alias(chrom), F.col("start").alias("_edge"), F.col("end").alias("_reach"))
    line = masked.unionByName(
        spans.select(chrom, F.col("end").alias("_edge"), F.lit(None).cast(masked.schema["_reach"].dataType).alias("_reach"))
    ).groupBy(chrom, "_edge").agg(F.max("_reach").alias("_reach"))
    reached = running(line, [chrom], "_edge", {"_masked_to": F.col("_reach")}, "max", inclusive=False).select(
        chrom, F.col("_edge").alias("end"), "_masked_to")
    touched = spans.hint(how).join(reached, [chrom, "end"]).filter(F.col("_masked_to") > F.col("start")).select(chrom, "start", "end")
    return intervals.join(touched.hint(how), [chrom, "start", "end"], "left_anti")
