"""Exact top-k by inner product: blocks of vectors, bounds from their maxima, pruned scoring."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import materialize

BLOCK = 256  # vectors per block
SLICE = 1 << 18  # vectors a task holds at a time
GROUP = 4096  # queries a task answers at a time, at most
NONE = -(1 << 62)  # below every score
BLOCKS = "block long, n int, dim int, item int, ids binary, names binary, rows binary, top binary, low binary"
SCORES = "query long, query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, ids: str, values: str, scale: float) -> DataFrame:
    """vec_id, x: floor(scale * component) of the vectors that take part.

    Vectors that are null, empty or hold null or non-finite components, and rows without an id,
    take no part. Every other row does, rows with one id and repeated rows too.
    """
    return (
        vectors.select(F.col(ids).alias("vec_id"), F.col(values).alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
        .where(F.forall("x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < math.inf), F.lit(False))))
        .select("vec_id", F.transform("x", lambda x: F.floor(scale * x.cast("double"))).alias("x"))
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with zeros, which change no product."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    rows = np.zeros((len(sizes), sizes.max(initial=0)), np.int64)
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = flat
    return rows


def _narrow(rows: np.ndarray) -> np.ndarray:
    small = rows.size == 0 or np.abs(rows).max() < 1 << 15
    return rows.astype(np.int16) if small else rows


def _build(batches):
    """Blocks of consecutive vectors: forward index, and per component the largest and smallest."""
    held: list[pa.RecordBatch] = []

    def blocks(all_rows: bool):
        nonlocal held
        table = pa.Table.from_batches(held).combine_chunks()
        whole = table.num_rows if all_rows else table.num_rows // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            part = table.slice(at, min(BLOCK, whole - at)).combine_chunks()
            ids, names = (part.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "name"))
            rows = _narrow(_matrix(part.column("x").chunk(0)))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": [int(names[0])],
                    "n": pa.array([rows.shape[0]], pa.int32()),
                    "dim": pa.array([rows.shape[1]], pa.int32()),
                    "item": pa.array([rows.itemsize], pa.int32()),
                    "ids": [ids.tobytes()],
                    "names": [names.tobytes()],
                    "rows": [rows.tobytes()],
                    "top": [rows.max(axis=0).astype(np.int64).tobytes()],
                    "low": [rows.min(axis=0).astype(np.int64).tobytes()],
                }
            )
        held = table.slice(whole).to_batches()

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= BLOCK:
            yield from blocks(False)
    if held:
        yield from blocks(True)


class _Best:
    """The k best so far of each query: scores descending, ties by id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), NONE)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        ids = np.concatenate([self.ids[rows], ids], axis=1)
        order = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(ids, order, axis=1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T: in floating point while every sum stays an exact integer there."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    if not dim:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * dim
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _search(k: int):
    def score(best, rows, queries, own, ids, names, vectors):
        """Scores of some queries in one block; the k best of the block go on."""
        found = _product(queries[rows], vectors)
        found[own[rows][:, None] == names[None, :]] = NONE
        n = min(k, found.shape[1])
        # ids ascend in a block, so the earliest place wins a tie
        picked = np.argsort(-found, axis=1, kind="stable")[:, :n]
        chosen = np.take_along_axis(found, picked, axis=1)
        best.add(rows, chosen, np.where(chosen > NONE, ids[picked], np.iinfo(np.int64).max))

    def search(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        ids, own = (queries.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "name"))
        asked = _matrix(queries.column("x").combine_chunks()) if len(own) else np.zeros((0, 0))
        index = []
        for b in blocks.to_pylist():
            kind = {2: np.int16, 8: np.int64}[b["item"]]
            rows = np.frombuffer(b["rows"], kind).reshape(b["n"], b["dim"])
            longs = [np.frombuffer(b[x], np.int64) for x in ("ids", "names", "top", "low")]
            index.append((*longs[:2], rows, *longs[2:]))
        best = _Best(len(own), k)
        if index and len(own):
            positive, negative = np.maximum(asked, 0), np.minimum(asked, 0)
            bounds = np.stack(
                [
                    (_product(positive, top[None]) + _product(negative, low[None]))[:, 0]
                    for *_, top, low in index
                ],
                axis=1,
            )
            todo = np.ones(bounds.shape, bool)
            first = bounds.argmax(axis=1)  # each query begins with its most promising block
            order = np.argsort(-bounds.max(axis=0), kind="stable")
            for step in ("own", "all"):
                for b in order:
                    rows = todo[:, b] & ((first == b) if step == "own" else bounds[:, b] >= best.floor())
                    rows = np.flatnonzero(rows)
                    if len(rows):
                        todo[rows, b] = False
                        score(best, rows, asked, own, *index[b][:3])
        full = best.scores > NONE
        return pa.table(
            {
                "query": np.repeat(own, full.sum(axis=1)),
                "query_id": np.repeat(ids, full.sum(axis=1)),
                "vec_id": best.ids[full],
                "score": best.scores[full],
            }
        )

    return search


def top_k(
    vectors: DataFrame,
    is_query,
    k: int,
    ids: str = "vec_id",
    values: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query.

    ``is_query`` is a condition on vec_id. Each row that meets it is a query, and every other row
    of the table is its candidate, rows with its id and equal vectors included; rows with one id
    are queries of their own, so that id then has each rank as often as it has rows. Ties go to
    the smaller id; a query with fewer candidates gets them all. See ``quantised`` for rows
    that take no part; vectors of unequal length are filled up with zeros. Scores must fit a
    long. An empty table gives no rows.

    Vectors are quantised once into a stored table, which gives each row a name of its own. Blocks
    are ranges of ids. Every group of queries meets every slice of blocks in a task of its own,
    bounded by GROUP and SLICE. Slices, not groups, are made for all cores: the few queries are
    copied rather than the blocks. In a task each query starts with the block of the highest
    bound (the sum over components of query times block maximum or minimum) and skips blocks
    whose bound lies below its k-th score. Only k rows per query and slice are shuffled on.
    """
    spark = vectors.sparkSession
    points = materialize(
        quantised(vectors, ids, values, scale).withColumn("name", F.monotonically_increasing_id())
    )
    asked = points.where(is_query(F.col("vec_id")))
    n, n_asked = points.count(), asked.count()
    width = max(4, spark.sparkContext.defaultParallelism)
    slices = max(1, math.ceil(n / SLICE), min(2 * width, math.ceil(n / (4 * BLOCK))))
    groups = max(1, math.ceil(n_asked / GROUP))
    blocks = (
        points.repartitionByRange("vec_id", "name")
        .sortWithinPartitions("vec_id", "name")
        .mapInArrow(_build, BLOCKS)
        .withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    )
    asked = asked.withColumn(
        "part", F.pmod(F.xxhash64("name"), F.lit(groups)).cast("int")
    ).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    found = (
        asked.groupBy("part", "slice")
        .cogroup(blocks.groupBy("part", "slice"))
        .applyInArrow(_search(k), SCORES)
    )
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
