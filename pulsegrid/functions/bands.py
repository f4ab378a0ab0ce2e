"""Severity and status bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest score of each severity, worst first; anything lower is "low".
SEVERITY_FLOORS = (("critical", 0.8), ("high", 0.6), ("medium", 0.4))
SEVERITY_RANK = {"critical": 1, "high": 2, "medium": 3, "low": 4}
SEVERITIES = tuple(SEVERITY_RANK)

# Panel thresholds, worst first; below all of them the status is "green".
STATUS_FLOORS = {
    "cpu_usage_percent": (("red", 80), ("yellow", 60)),
    "memory_usage_percent": (("red", 85), ("yellow", 70)),
    "cpu_temperature_celsius": (("red", 80), ("orange", 70), ("yellow", 60)),
    "total_power_watts": (("red", 100000), ("yellow", 50000)),
    "response_time_p95_ms": (("red", 200), ("yellow", 100)),
    "error_rate_percent": (("red", 5), ("yellow", 1)),
    "anomalies_per_hour": (("red", 30), ("orange", 15), ("yellow", 5)),
    "critical_entities": (("red", 1),),
}


def _first_reached(value: Column, floors, otherwise: str) -> Column:
    band = reduce(
        lambda chain, step: chain.when(value >= step[1], step[0]),
        floors[1:],
        F.when(value >= floors[0][1], floors[0][0]),
    )
    return band.otherwise(otherwise)


def severity(score: Column) -> Column:
    return _first_reached(score, SEVERITY_FLOORS, "low")


def severity_rank(name: Column) -> Column:
    """1 for the worst; NULL for an unknown name."""
    return reduce(
        lambda chain, item: chain.when(name == item[0], item[1]),
        list(SEVERITY_RANK.items())[1:],
        F.when(name == "critical", 1),
    )


def panel_status(value: Column, panel: str) -> Column:
    return F.when(value.isNotNull(), _first_reached(value, STATUS_FLOORS[panel], "green"))
