"""What the two classifiers share: folds, bounded labelled samples, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned; a document without an id is not one of them."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """text, label, turn of at most ``rows`` labelled documents outside the held-out fold.

    Of more, those with the smallest hashes of their ids are taken, as ``turn`` 0, 1 and so on.
    Labels other than 0 and 1, and labels or documents without an id, are left out; of several
    labels of one id the largest counts.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .select("doc_id", "label")
    )
    # at most ``rows`` ids and numbers
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select(
        "text", "label", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)).alias("turn")
    )


def calibrated(values: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve that turns values into probabilities of 1.

    Newton steps with a light pull towards slope 0; without values, or with one class only, the
    curve is flat at the share of 1 (or one half).
    """
    n, ones = len(y), float(np.sum(y))
    offset = float(np.log((ones + 0.5) / (n - ones + 0.5)))
    if not 0 < ones < n:
        return 0.0, offset
    center, scale = float(np.mean(values)), float(np.std(values)) or 1.0
    x = np.stack([(values - center) / scale, np.ones(n)], axis=1)
    w = np.array([0.0, offset])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 1e-3 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -2, 2)
    return float(w[0] / scale), float(w[1] - w[0] * center / scale)


def probability(values: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * values + offset, -50, 50)))


def rising(values: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising curve closest to y (pool adjacent violators), for ``np.interp``.

    Half a case of each class is added to every level. Without values, or with one class only,
    there is one knot at the share of 1 (or one half).
    """
    levels: list[list[float]] = []  # cases, ones, sum of values
    for value, one in sorted(zip(values.tolist(), y.tolist(), strict=True)):
        levels.append([1.0, one, value])
        while len(levels) > 1 and levels[-2][1] * levels[-1][0] >= levels[-1][1] * levels[-2][0]:
            last = levels.pop()
            levels[-1] = [a + b for a, b in zip(levels[-1], last, strict=True)]
    if len(levels) < 2 or not 0 < np.sum(y) < len(y):
        return np.zeros(1), np.array([(np.sum(y) + 0.5) / (len(y) + 1)])
    n, ones, total = np.array(levels).T
    return total / n, np.maximum.accumulate((ones + 0.5) / (n + 1))
