"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: data folder (default sf0.1). BENCH_CPUS: local cores (default all). BENCH_RUNS: timed runs
per query after one warm-up run (default 1; the median counts). BENCH_QUERIES: names, blank-separated, or
`all`.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cutgrid.plans.catalog import QUERIES  # noqa: E402
from cutgrid.session import build_session  # noqa: E402


HEADLINE = [
    "site_counts", "nearest_site", "site_merge", "dedup_lists", "site_bed", "assign_stats", "group_positions",
    "flag_extract", "prefix_filter", "flag_stats", "read_qc_by_position", "alignment_position", "alignment_counts",
    "motif_sites", "sliding_bins", "custom_bins", "masked_sites", "bin_scores", "run_scores", "library_summary",
    "fastq_scan",
]


def run_once(spark, sf_dir: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    scratch = tempfile.mkdtemp(prefix="cutgrid-bench-")
    spark = build_session("bench", cores=cpus, spark__checkpoint__dir=scratch)
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        run_once(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run_once(spark, sf_dir, name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum over queries of the median of warm runs", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
