"""Registered queries with their oracle SQL."""

from . import clean_queries, cluster_queries, feature_queries, json_queries, relate_queries, source_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
