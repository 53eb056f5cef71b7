"""Registered queries over the given tables, each with the SQL it must equal."""

from __future__ import annotations

from etlkit.queries.registry import ORACLES, QUERIES
from etlkit.queries import (  # noqa: F401  (importing registers the queries)
    aggregates, columns, filters, joins, lifecycle, quality, storage, streams,
)

__all__ = ["ORACLES", "QUERIES"]
