"""Query catalogue: importing this package registers every query."""

from . import clean_queries, monitor_queries, profile_queries, sampling_queries, source_queries, stream_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
