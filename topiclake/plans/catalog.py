"""All named queries; importing the modules registers them."""

from topiclake.plans import event_queries, format_queries, metric_queries, panel_queries, table_queries  # noqa: F401
from topiclake.plans.bound import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
