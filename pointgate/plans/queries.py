"""All registered queries."""

from pointgate.plans import feed_queries, file_queries, function_queries, gate_queries, sink_queries  # noqa: F401
from pointgate.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
