"""All registered queries."""

from workload import mart_queries, operator_queries, source_queries, typing_queries  # noqa: F401  (they register)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
