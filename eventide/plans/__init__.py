"""Registered queries over the driver tables, each with a DuckDB oracle."""

from eventide.plans.registry import QUERIES, ORACLES  # noqa: F401
from eventide.plans import search_queries, mapping_queries, flagship, detect_queries, store_queries, landed_queries  # noqa: F401
