"""Registered queries, each with an independent SQL statement to check it by."""

from tallyward.catalog.registry import REGISTRY
from tallyward.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates, cohorts, filters, joins, many, measures, scalars, scans, sets,
)

__all__ = ["REGISTRY"]
