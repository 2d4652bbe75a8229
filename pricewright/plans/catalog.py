"""All registered queries."""

from pricewright.plans import (  # noqa: F401
    queries_cleaning,
    queries_files,
    queries_forecast,
    queries_pricing,
    queries_reconcile,
    queries_segment,
)
from pricewright.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
