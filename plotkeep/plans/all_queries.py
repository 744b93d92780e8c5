"""Importing this module registers every query."""

from plotkeep.plans import (  # noqa: F401
    prose_queries,
    spatial_queries,
    stream_queries,
    tables_queries,
    versions_queries,
)
