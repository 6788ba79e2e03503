"""All registered queries; importing the modules registers them."""

from touchline.plans import click_queries, event_queries, report_queries, sql_queries, stream_queries  # noqa: F401
from touchline.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
