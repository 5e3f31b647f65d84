"""All registered queries."""

from courier.plans import (  # noqa: F401
    cycle_queries,
    outcome_queries,
    queue_queries,
    routing_queries,
    sql_queries,
    text_queries,
    transfer_queries,
)
from courier.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
