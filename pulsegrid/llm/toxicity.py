"""Toxicity scores: subword-bag embeddings averaged into a linear softmax, trained jointly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm import labelled
from pulsegrid.llm.words import LOWER, NOT_BLANK, chunks, mixed

LENGTHS = (4, 5, 6)  # bytes of a subword, word ends included
BUCKETS = 1 << 18
DIMENSIONS = 8
SAMPLE = 3_000  # most labelled documents the model is fitted on
LONGEST = 1 << 16  # characters of a document the model is fitted on at most
STEPS, RATE, MOMENTUM = 80, 3.0, 0.9
SEED = 11


# ---- subwords ----------------------------------------------------------------------------


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with one blank before each text and after the last, all white space as
    blanks, and where each text's first blank stands."""
    data = np.where(NOT_BLANK[data], LOWER[data], 0x20)
    return np.insert(data, offsets, 0x20), offsets + np.arange(len(offsets))


def _grams(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and buckets of all subwords of one length; blanks only at their ends."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blanks = np.concatenate([[0], np.cumsum(codes == 0x20)])
    inside = blanks[length - 1 : length - 1 + n] == blanks[1 : n + 1]
    at = np.flatnonzero(inside)
    h = np.full(len(at), length, np.uint64)
    for k in range(length):
        h = h * np.uint64(0x100000001B3) + codes[at + k]
    return at, (mixed(h) % np.uint64(BUCKETS)).astype(np.int64)


def _owners(at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whose each place is; every text ends with the blank of the next."""
    return np.searchsorted(starts, at, side="right") - 1


# ---- the model ---------------------------------------------------------------------------


class Model:
    """A vector per subword bucket, averaged over a text, then a softmax over two classes.

    All of it is linear up to the softmax, so a trained model is one number per bucket.
    """

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each text; a text without subwords gets the bias alone."""
        codes, starts = _padded(data, offsets)
        n = len(offsets) - 1
        total, count = np.zeros(n), np.zeros(n)
        for length in LENGTHS:
            at, bucket = _grams(codes, length)
            edges = np.searchsorted(at, starts)
            sums = np.concatenate([[0.0], np.cumsum(self.weight[bucket])])
            total += sums[edges[1:]] - sums[edges[:-1]]
            count += np.diff(edges)
        return labelled.probability(total / np.maximum(count, 1), 1.0, self.bias)


def train(texts: list[str], labels: list[int], steps: int = STEPS) -> Model:
    """Fit embeddings and softmax together, by descent with momentum over all texts at a time.

    Subwords count by their inverse document frequency in a text's average, so that the many
    common ones do not drown a few telling ones. Every fifth text only calibrates the scores.
    With one class missing every score is the share of class 1, or one half without texts.
    """
    y = np.array(labels, float)
    flat = np.zeros(BUCKETS, np.float32)
    if not 0 < y.sum() < len(y):
        return Model(flat, labelled.calibrated(np.zeros(len(y)), y)[1])
    bucket, owner, share = _bags(texts)
    spread = np.bincount(bucket, minlength=BUCKETS)
    rarity = np.log((len(y) + 1) / (spread + 1)).astype(np.float32)
    value = share * rarity[bucket]
    size = float(np.sqrt(np.bincount(owner, value**2, len(y))).mean()) or 1.0
    value /= size
    fits = np.arange(len(y)) % 5 > 0
    even = np.where(y == 1, 0.5 / max(1, y[fits].sum()), 0.5 / max(1, (1 - y[fits]).sum())) * fits
    rng = np.random.default_rng(SEED)
    vectors = rng.normal(0, 0.01, (BUCKETS, DIMENSIONS)).astype(np.float32)
    axis = rng.normal(0, 1, DIMENSIONS).astype(np.float32)  # class 1 less class 0
    axis /= np.linalg.norm(axis)
    offset, pace = 0.0, [np.zeros_like(vectors), np.zeros_like(axis)]
    for _ in range(steps):
        z = np.bincount(owner, value * (vectors @ axis)[bucket], len(y)) + offset
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * even
        pull = np.bincount(bucket, value * error[owner], BUCKETS).astype(np.float32)
        pace[0] = MOMENTUM * pace[0] - RATE * pull[:, None] * axis
        pace[1] = MOMENTUM * pace[1] - 0.01 * RATE * (vectors.T @ pull)
        vectors += pace[0]
        axis = axis + pace[1]
        offset -= float(error.sum())
    z = np.bincount(owner, value * (vectors @ axis)[bucket], len(y)) + offset
    rest = ~fits if 0 < y[~fits].sum() < (~fits).sum() else fits
    slope, shift = labelled.calibrated(z[rest], y[rest])
    weight = (vectors @ axis) * rarity * (slope / size)
    return Model(weight.astype(np.float32), slope * offset + shift)


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, text and share of each bucket in each text."""
    buckets, owners, weights, row = [], [], [], 0
    for first, data, offsets in chunks(pa.array(texts)):
        codes, starts = _padded(data, offsets)
        found = [_grams(codes, length) for length in LENGTHS]
        owner = np.concatenate([_owners(at, starts) for at, _ in found])
        keys = owner * BUCKETS + np.concatenate([b for _, b in found])
        keys, counts = np.unique(keys, return_counts=True)
        size = np.bincount(owner, minlength=len(offsets) - 1)
        buckets.append((keys % BUCKETS).astype(np.int32))
        owners.append((keys // BUCKETS + first).astype(np.int32))
        weights.append((counts / size[keys // BUCKETS]).astype(np.float32))
    return np.concatenate(buckets), np.concatenate(owners), np.concatenate(weights)


# ---- on Spark ----------------------------------------------------------------------------


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE) -> Model:
    """Train on the driver, on at most ``rows`` labelled documents outside the held-out fold. Of a
    longer document LONGEST characters are taken, at a place that its hash chooses."""
    room = F.greatest(F.length("text") - LONGEST, F.lit(0)) + 1
    place = F.pmod(F.xxhash64("text"), room).cast("int") + 1
    chosen = (
        labelled.sample(docs, labels, label, rows)
        .withColumn("text", F.substring("text", place, F.lit(LONGEST)))
        .orderBy("turn", "text")
        .collect()
    )
    return train([r["text"] for r in chosen], [r["label"] for r in chosen])


def score(docs: DataFrame, model: Model, toxic: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Whole texts are scored. A null or empty text has no subwords and gets the bias alone.
    Repeated rows are scored each, alike. Needs doc_id and text; no other column is read.
    """

    def scored(batches):
        for batch in batches:
            for row, data, offsets in chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, len(offsets) - 1),
                        pa.array(model.scores(data, offsets)),
                    ],
                    ["doc_id", "score"],
                )

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scored, "doc_id long, score double"
    )
    return found.select(
        "doc_id",
        labelled.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxic).cast("int").alias("predicted"),
    )
