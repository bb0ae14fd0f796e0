"""Counts out of the text logs that earlier runs left behind."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cutgrid.functions.text import whole_number


@dataclass(frozen=True)
class Metric:
    """A summary column that a log line carries: capture group `group` of `pattern` in `stage`."""

    name: str
    stage: str
    pattern: str
    group: int
    is_text: bool = False


# The log lines of the preprocessing tools, matched from the start of the line.
QUALITY_LINE = r"^.* ([0-9]+)/([0-9]+) \(([0-9\.%]+)\).*flag_extract\.py:246"
PREFIX_LINE = r"^.* ([0-9]+)/([0-9]+) \(([0-9\.%]+)\).*flag_regex\.py:156"
UNMAPPED_LINE = r"^.* ([0-9]+) \([0-9\.]+%\) aligned 0 times"
SECOND_LINE = r"^.* ([0-9]+) \([0-9\.]+%\) aligned >1 times"
FROM_SITE_LINE = r"^.* Output: ([0-9]+) \(([0-9\.]+%)\) UMI sequences over "
DEDUP_LINE = r"^([0-9]+) UMIs left after deduplication."
COUNT_LINE = r"^\s*([0-9]+)\s*$"

METRICS = [
    Metric("umi_hq", "quality", QUALITY_LINE, 1),
    Metric("input", "quality", QUALITY_LINE, 2),
    Metric("umi_hq%", "quality", QUALITY_LINE, 3, is_text=True),
    Metric("prefix", "prefix", PREFIX_LINE, 1),
    Metric("prefix%", "prefix", PREFIX_LINE, 3, is_text=True),
    Metric("unmapped", "mapping", UNMAPPED_LINE, 1),
    Metric("2nd_aln", "mapping", SECOND_LINE, 1),
    Metric("chrM", "chrM", COUNT_LINE, 1),
    Metric("low_mapq", "low_mapq", COUNT_LINE, 1),
    Metric("mapped", "clean", COUNT_LINE, 1),
    Metric("fromCS", "site", FROM_SITE_LINE, 1),
    Metric("fromCS%", "site", FROM_SITE_LINE, 2, is_text=True),
    Metric("uniq", "dedup", DEDUP_LINE, 1),
]


def log_metrics(lines: DataFrame, metrics: list[Metric] = METRICS) -> DataFrame:
    """One row per library with every metric; the last matching line wins, null when none matches.

    `lines` has `libid, stage, line_no, line`. In one-number files the first line counts.
    """
    def matched(metric: Metric):
        here = (F.col("stage") == metric.stage) & F.col("line").rlike(metric.pattern)
        return here & (F.col("line_no") == 0) if metric.pattern == COUNT_LINE else here

    columns = []
    for metric in metrics:
        text = F.when(matched(metric), F.regexp_extract("line", metric.pattern, metric.group))
        last = F.max_by(text, F.when(matched(metric), F.col("line_no")))
        columns.append((last if metric.is_text else whole_number(last)).alias(metric.name))
    return lines.groupBy("libid").agg(*columns)


def missing_metrics(found: DataFrame, metrics: list[Metric] = METRICS) -> DataFrame:
    """Library and name of every metric that no log line gave."""
    names = [m.name for m in metrics]
    absent = F.array_compact(F.array(*[F.when(F.col(f"`{n}`").isNull(), F.lit(n)) for n in names]))
    return found.select("libid", F.explode(absent).alias("metric"))


def require_metrics(found: DataFrame, metrics: list[Metric] = METRICS) -> DataFrame:
    """The same table, but reading it fails when a library lacks a metric."""
    checked = {
        m.name: F.when(F.col(f"`{m.name}`").isNull(), F.raise_error(
            F.concat(F.lit(f"missing {m.name} line of library "), F.col("libid"))
        )).otherwise(F.col(f"`{m.name}`")) for m in metrics
    }
    return found.select("libid", *[c.alias(n) for n, c in checked.items()])
