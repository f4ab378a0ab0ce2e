"""Registered queries over the driver's tables, each with its SQL counterpart where one exists."""

from . import anomaly_queries, column_queries, metric_queries, training_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
