"""Checked queries over the test tables."""

from meterflow.queries import (  # noqa: F401
    bucket_queries,
    edge_queries,
    normalize_queries,
    sink_queries,
    source_queries,
    state_queries,
    stream_queries,
    time_queries,
    transform_queries,
)
from meterflow.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
