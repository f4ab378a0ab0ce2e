import random

import pytest

from pulsegrid.llm import jaccard
from tests.llm import brute
from tests.llm.conftest import ODD


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("shingle, percent", [(3, 90), (5, 80), (1, 60)])
def test_agrees_with_brute_force(documents, monkeypatch, shingle, percent):
    """Groups around a text, chains without one, and one group large enough for blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(percent)
    texts = [[f"w{rng.randrange(4000)}" for _ in range(rng.choice([1, 2, 4, 9, 30, 120, 400]))] for _ in range(40)]
    docs = []
    for k, words in enumerate(texts):
        docs += [near(rng, words, rng.randrange(1 + len(words) // 40)) for _ in range(k % 4)] + [words]
    base = [f"g{k}" for k in range(150)]
    docs += [near(rng, base, rng.randrange(1, 7)) for _ in range(90)]
    chain = [f"c{k}" for k in range(120)]
    for k in range(12):
        chain[10 * k % 120] = f"d{k}"
        docs.append(list(chain))
    rng.shuffle(docs)
    docs = [(k, " ".join(w)) for k, w in enumerate(docs)] + [(900, None), (901, ""), (902, docs and " ".join(base))]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(documents(*docs), shingle, percent).collect()}
    assert found == brute.components(docs, shingle, percent)


def test_odd_rows(documents):
    rows = jaccard.link(documents(*ODD, (9, "NO ID at all here"))).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)
    expected = [(None, 1, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5), (5, 1, 5), (6, 1, 6), (9, 1, None)]
    assert found == sorted(expected, key=str)


def test_empty_table(documents):
    assert jaccard.link(documents()).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (300, 200)]
    found = {r.sid: r.component for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {100: 100, 200: 100, 300: 100}


def test_long_texts_have_longer_sketches(documents):
    rng = random.Random(4)
    base = [f"b{rng.randrange(10**6)}" for _ in range(18_000)]
    half = base[:9_000] + [f"h{rng.randrange(10**6)}" for _ in range(9_000)]
    rows = [(k, " ".join(near(rng, base, 100))) for k in range(2)] + [(k + 5, " ".join(near(rng, half, 40))) for k in range(2)]
    rows += [(9, " ".join(base[:3_000])), (10, " ".join(near(rng, base[:3_000], 20))), (11, " ".join(half[-3_000:]))]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(documents(*rows)).collect()}
    assert found == brute.components(rows, jaccard.SHINGLE, jaccard.PERCENT)
    assert {c for _, c in found.values()} == {0, 5, 9, 11}


def test_sketches_bound_the_difference_of_sets():
    import numpy as np

    rng = np.random.default_rng(0)
    sizes = np.array([10, 2500, 17_000])
    h = rng.integers(0, 2**63, sizes.sum()).astype(np.uint64)
    words, owner = jaccard._short_sketches(h, np.repeat([0, 1, 2], sizes), sizes)
    assert np.bincount(owner).tolist() == list(jaccard.SKETCH_ENDS)
    ones = [int(np.bitwise_count(words[owner == k].view(np.uint64)).astype(int).sum()) for k in range(3)]
    assert ones[0] == 10 and ones[1] <= 2 * 2500 and ones[2] <= 3 * 17_000


def test_a_passage_of_many_texts_makes_no_pairs(documents, monkeypatch):
    """Only texts that share rare shingles too are paired, so pairs do not grow with the square of
    the texts that hold a passage."""
    asked, chosen = [], jaccard._near

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return chosen(pairs, *rest)

    monkeypatch.setattr(jaccard, "_near", counted)
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(40)]
    texts = [[f"t{rng.randrange(10**6)}" for _ in range(30)] + passage for _ in range(160)]
    texts.append([*texts[3][:-1], "other"])
    rows = [(k, " ".join(words)) for k, words in enumerate(texts)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(documents(*rows)).collect()}
    assert found == brute.components(rows, jaccard.SHINGLE, jaccard.PERCENT)
    assert found[160] == (66, 3)
    assert sum(asked) <= 5


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_sets_in_reach_share_a_prefix_shingle_in_any_order(percent):
    import numpy as np

    rng = np.random.default_rng(percent)
    for trial in range(300):
        common = rng.integers(0, 4, 1 << jaccard.SLOT_BITS).astype(np.uint8)
        pool = np.unique(rng.integers(0, 2**64, rng.integers(2, 60), np.uint64))
        a = np.sort(rng.choice(pool, rng.integers(1, len(pool) + 1), replace=False))
        b = np.sort(rng.choice(pool, rng.integers(1, len(pool) + 1), replace=False))
        both = len(np.intersect1d(a, b))
        keys, owner = jaccard._rarest(
            np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), common, 2, percent
        )
        if 100 * both >= percent * (len(a) + len(b) - both):
            assert np.intersect1d(keys[owner == 0], keys[owner == 1]).size, trial
