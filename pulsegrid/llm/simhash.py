"""Near-duplicates by SimHash: fingerprints meet half-way, in balls around each of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.jaccard import components
from pulsegrid.session import materialize

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
COUNTED = 1 << 18  # hashes whose bits are counted at a time
CLOSE = 2048  # members of a bucket that are compared with each other at a time

EDGES = "a long, b long"


# ---- fingerprints ------------------------------------------------------------------------


def _hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 of every n-word shingle of a text, or of its whole word sequence if that is shorter."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # for bytes: A-Z only, and exactly the six blanks of ASCII
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = min(n, len(words))
    spans = zip((ends - sizes)[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)
    found = (xxh64_intdigest(joined[a:b], SEED) for a, b in spans)
    return np.fromiter(found, np.uint64, len(words) - n + 1)


def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes."""
    h = _hashes(text, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), COUNTED):
        bits = np.unpackbits(h[at : at + COUNTED].astype("<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (64 bits as a signed number) of every row; no words or text give 0."""

    def rows(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((fingerprint(x.as_py(), shingle) for x in texts), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(
        rows, "doc_id long, fp long"
    )


# ---- balls -------------------------------------------------------------------------------


def ball(radius: int) -> list[tuple[int, int]]:
    """(clear, flip) pairs: what to clear and then flip in a fingerprint to get its variants.

    Two fingerprints at an even distance of 2r or less share a variant at r flips from each. An odd
    radius is made even first: the bits are split into three blocks, and each is cleared in turn.
    Two fingerprints that differ in 2r + 1 bits or fewer differ in 2r or fewer once a block with one
    of these bits is cleared, and meet half-way in the rest. A block of one third keeps 42 bits or
    more to tell buckets apart.
    """
    half, odd = divmod(radius, 2)
    if half > 1:
        raise ValueError("radius must be at most 3")
    thirds = [sum(1 << i for i in range(a, b)) for a, b in ((0, 22), (22, 43), (43, BITS))]
    pairs = []
    for cleared in thirds if odd else [0]:
        flips = [1 << i for i in range(BITS) if not cleared >> i & 1] if half else []
        pairs += [(cleared, flip) for flip in [0, *flips]]
    return pairs


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """bucket and fp for every variant of every fingerprint in ``distinct``. A bucket's name tells
    the cleared block too, through the bits that are kept."""

    def word(x: int):
        return F.lit(x - (1 << BITS) if x >> (BITS - 1) else x).cast("long")

    every = (1 << BITS) - 1
    steps = F.array(
        *(F.struct(word(every & ~c).alias("keep"), word(f).alias("flip")) for c, f in ball(radius))
    )
    kept = F.col("fp").bitwiseAND(F.col("step.keep"))
    return distinct.select("fp", F.explode(steps).alias("step")).select(
        F.xxhash64("step.keep", kept.bitwiseXOR(F.col("step.flip"))).alias("bucket"), "fp"
    )


def _forest(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within ``radius`` among some fingerprints, one fewer
    than there are in each connected part: from each member reached, all that are not reached yet
    and close enough to it."""
    left, a, b = fp.copy(), [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:CLOSE], front[CLOSE:]
            nearest = np.full(len(left), -1)
            for k, x in enumerate(some):
                close = (nearest < 0) & (np.bitwise_count(left ^ x) <= radius)
                nearest[close] = k
            found = nearest >= 0
            a.append(some[nearest[found]])
            b.append(left[found])
            front, left = np.concatenate([front, left[found]]), left[~found]
    return np.concatenate(a or [fp[:0]]), np.concatenate(b or [fp[:0]])


def _bucket_links(radius: int):
    """Links within buckets that come one behind the other; a bucket may span batches."""

    def linked(bucket: np.ndarray, fp: np.ndarray):
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.append(starts[1:], len(bucket))
        a, b = [fp[:0]], [fp[:0]]
        pairs = starts[ends - starts == 2]
        x, y = fp[pairs], fp[pairs + 1]
        near = np.bitwise_count(x ^ y) <= radius
        a.append(x[near])
        b.append(y[near])
        for low, high in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
            x, y = _forest(fp[low:high], radius)
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)

    def rows(batches):
        bucket, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            more = batch.column("fp").to_numpy().view(np.uint64)
            bucket = np.concatenate([bucket, batch.column("bucket").to_numpy()])
            fp = np.concatenate([fp, more])
            if not len(bucket) or bucket[0] == bucket[-1]:
                continue  # a bucket that may go on
            last = int(np.flatnonzero(bucket != bucket[-1])[-1]) + 1
            yield _edges(linked(bucket[:last], fp[:last]))
            bucket, fp = bucket[last:], fp[last:]
        if len(bucket):
            yield _edges(linked(bucket, fp))

    return rows


def _edges(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def near(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect exactly what is connected by links within ``radius``.

    A bucket holds different fingerprints only, all of them within two flips once the block is
    cleared: its size is bounded by the 22 cleared bits and not by the rows. Within it links are
    verified and a spanning forest of them is kept, so no bucket gives all of its pairs.
    """
    return (
        variants(distinct, radius)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_bucket_links(radius), EDGES)
        .distinct()
    )


def link(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs``.

    Words are lower-cased in A-Z and end at blanks; a fingerprint counts each shingle as often as it
    occurs. Two documents link if their fingerprints differ in ``radius`` bits or fewer;
    component_id is the smallest doc_id reachable. Needs doc_id and text. A document without words
    or text has fingerprint 0 and links like any other. A null id is reported as null and names no
    component: component_id is null only where every id reachable is. Repeated rows, and rows with
    one id, are documents of their own. Equal fingerprints are one node from the start.
    """
    marked = materialize(fingerprints(docs, shingle))
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    edges = materialize(near(nodes.select("fp"), radius))
    found = components(edges).withColumnRenamed("sid", "fp")
    grouped = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    names = grouped.join(smallest, "component").select("fp", "component_id")
    return marked.join(names, "fp").select("doc_id", "fp", "component_id")
