"""All queries of the package over the test tables, with the SQL that states the same result."""

from cutgrid.plans.catalog import alignments, files, genome, reads, runs, scores, summary, umis  # noqa: F401
from cutgrid.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
