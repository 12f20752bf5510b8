"""Queries of the panel library over the driver's tables, and their SQL."""

from . import analyst_queries, bar_queries, dataset_queries, exposure_queries, fact_queries, more_queries, panel_queries, report_queries, risk_queries, store_queries, style_queries, table_queries, universe_queries, whole_report_queries  # noqa: F401  (they register themselves)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
