"""Registered queries by name."""

from trackledger.catalog import files, jobs, packing, reconciling, reports
from trackledger.catalog.base import Query

QUERIES: dict[str, Query] = {
    **reports.QUERIES,
    **reconciling.QUERIES,
    **packing.QUERIES,
    **files.QUERIES,
    **jobs.QUERIES,
}
