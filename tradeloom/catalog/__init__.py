"""The query catalogue: what can be run over the given tables, and what it must return."""

from tradeloom.catalog import (  # noqa: F401
    function_queries,
    landing_queries,
    ops_queries,
    staging_queries,
    star_queries,
)
from tradeloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
