"""SimHash fingerprints bit by bit, and components against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import simhash

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def plain_fingerprint(text):
    from xxhash import xxh64

    words = WORD.findall((text or "").translate(LOWER))
    n = min(3, len(words))
    hashes = [xxh64(" ".join(words[k : k + n]), seed=42).intdigest() for k in range(len(words) - n + 1) if n]
    bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b])


def plain_components(rows):
    """Smallest id reachable per row of (id, fingerprint), comparing all pairs."""
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (_, x) in enumerate(rows):
        for j, (_, y) in enumerate(rows[:i]):
            if (x ^ y).bit_count() <= 3:
                parent[root(i)] = root(j)
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        ids.setdefault(root(k), []).append(doc_id)
    return [min((x for x in ids[root(k)] if x is not None), default=None) for k in range(len(rows))]


def unsigned(x):
    return x % (1 << 64)


def test_documents_link_as_all_pairs_say(documents):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(500)]
    rows = list(ODD)
    for k in range(40):
        body = rng.choices(words, k=rng.choice([3, 30, 300]))
        for copy in range(rng.choice([1, 1, 2, 5])):
            edited = list(body)
            for _ in range(copy):
                edited[rng.randrange(len(edited))] = rng.choice(words).upper()
            rows.append((100 + 10 * k + copy, "\t".join(edited)))
    marked = [(r[0], plain_fingerprint(r[1])) for r in rows]
    found = simhash.link(documents(*rows)).collect()
    want = [(*m, c) for m, c in zip(marked, plain_components(marked), strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r[0], unsigned(r[1]), r[2]) for r in found), key=key) == sorted(want, key=key)
    assert len({c for *_, c in want}) < len({m[1] for m in marked})


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_balls_meet_exactly_within_the_radius(spark, radius):
    rng = random.Random(radius)
    values = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(60):
        start = rng.getrandbits(64)
        values.add(start)
        for _ in range(4):
            flips = rng.sample(range(64), rng.randint(1, 4))
            values.add(start ^ sum(1 << b for b in flips))
    values = sorted(values)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in values]
    edges = [(unsigned(a), unsigned(b)) for a, b in simhash.near(spark.createDataFrame(signed, "fp long"), radius).collect()]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in edges)
    parent = {x: x for x in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    for i, x in enumerate(values):
        for y in values[:i]:
            assert (x ^ y).bit_count() > radius or root(x) == root(y)


def test_every_three_bits_meet_in_some_variant():
    steps = simhash.ball(3)
    rng = random.Random(0)
    for _ in range(300):
        x = sum(1 << b for b in rng.sample(range(64), 3))
        ours = {(c, f) for c, f in steps}
        theirs = {(c, (x & ~c) ^ f) for c, f in steps}
        assert ours & theirs


def test_a_bucket_keeps_a_forest_and_spans_batches():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    fp = np.unique(np.array([sum(1 << int(b) for b in rng.choice(22, 2)) for _ in range(500)], np.uint64))
    bucket = np.full(len(fp), 5)
    cut = len(fp) // 2
    batches = [
        pa.record_batch([pa.array(bucket[a:b]), pa.array(fp[a:b].view(np.int64))], ["bucket", "fp"])
        for a, b in ((0, cut), (cut, len(fp)))
    ]
    edges = [e for batch in simhash._bucket_links(3)(batches) for e in batch.to_pylist()]
    assert len(edges) == len(fp) - 1
    assert all((e["a"] ^ e["b"]).bit_count() <= 3 for e in edges)


def test_an_empty_table_gives_no_rows(documents):
    assert simhash.link(documents(*ODD).where(F.lit(False))).count() == 0
