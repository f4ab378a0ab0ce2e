"""Detection methods and their registry: the extension point for new detectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict
from typing import Protocol

from pyspark.sql import DataFrame

from ..config import StlConfig
from . import fitting, scoring


_KNOWN: dict[str, type] = {}


def detector(cls: type) -> type:
    """Class decorator: offer a detection method under its ``name``."""
    if _KNOWN.setdefault(cls.name, cls) is not cls:
        raise ValueError(f"two detection methods are called {cls.name}")
    return cls


def detectors() -> frozenset[str]:
    return frozenset(_KNOWN)


def make_detector(name: str, settings: dict | None = None) -> DetectionMethod:
    try:
        kind = _KNOWN[name]
    except KeyError:
        raise LookupError(f"no detection method {name!r} (known: {sorted(_KNOWN)})") from None
    return kind(settings)


class DetectionMethod(Protocol):
    name: str

    def get_config(self) -> dict: ...

    def fit(
        self, history: DataFrame, skip_below: int = 100, partitions: int | None = None
    ) -> DataFrame:
        """Long history (entity_id, metric_name, timestamp, value) -> one outcome per series."""

    def predict(self, readings: DataFrame, models: DataFrame, metrics: Sequence[str], **options):
        """Wide readings and models -> scored rows."""


@detector
class StlZscore:
    name = "stl_zscore"

    def __init__(self, config: dict | StlConfig | None = None):
        self.config = config if isinstance(config, StlConfig) else StlConfig(**(config or {}))

    def get_config(self) -> dict:
        return asdict(self.config)

    def fit(
        self, history: DataFrame, skip_below: int = 100, partitions: int | None = None
    ) -> DataFrame:
        return fitting.fit_series(history, self.config, skip_below, partitions)

    def predict(
        self, readings: DataFrame, models: DataFrame, metrics: Sequence[str], **options
    ) -> DataFrame:
        return scoring.score(
            readings, models, metrics, threshold=self.config.z_score_threshold, **options
        )

    def __repr__(self) -> str:
        return f"StlZscore(config={self.get_config()})"
