"""Training-data operators: quality, deduplication, mixing, scoring, packing, extraction."""

from .entries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
