"""Import every query module so the registry is complete."""

from __future__ import annotations

from halyard.plans import (  # noqa: F401
    q_allocation, q_customer, q_gateway, q_metrics, q_ml, q_scheduling, q_streaming, q_timeseries, workflows,
)
from halyard.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
