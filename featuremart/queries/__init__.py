"""Registered queries: every operator and job over the test tables, each with its oracle."""

from featuremart.queries import (  # noqa: F401  (importing registers the queries)
    aggregates,
    columns,
    filters,
    jobs,
    joins,
    scans,
    scoring,
    sinks,
    windows,
)
from featuremart.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
