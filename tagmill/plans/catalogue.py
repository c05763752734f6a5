"""All registered queries."""

from tagmill.plans import cohort_queries, model_queries, selection_queries  # noqa: F401
from tagmill.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
