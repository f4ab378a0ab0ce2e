import math
import random

import numpy as np
import pytest

from pulsegrid.llm import licenses, topk
from tests.llm import brute
from tests.llm.conftest import ODD


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, x int")


def by_row(points, k):
    """The k best of each row whose id is divisible by 20, among all other rows; ids repeat."""
    whole = [(key, [math.floor(64 * v) for v in x]) for key, x in points]
    found = []
    for at, (query, x) in enumerate(whole):
        if query % 20 == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(x, y, strict=True)), other)
                for place, (other, y) in enumerate(whole)
                if place != at
            )
            found += [(query, r + 1, other, -s) for r, (s, other) in enumerate(scores[:k])]
    return sorted(found)


def test_every_row_but_the_querys_own_is_a_candidate(spark):
    a, b = [1.0, 0.0], [0.5, 1.0]
    for points in (
        [(20, a), (20, a), (1, b)],
        [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (1, b), (1, b), (1, a), (2, [1.0, 1.0])],
    ):
        found = topk.top_k(vectors(spark, [(k, x, 0, "s", 1) for k, x in points]), lambda v: v % 20 == 0, 20)
        assert sorted(tuple(r) for r in found.collect()) == by_row(points, 20)


def test_repeated_rows_and_ids_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "SLICE", 50)
    monkeypatch.setattr(topk, "GROUP", 5)
    rng = np.random.default_rng(3)
    # a third of all rows is one query's row; other ids repeat with equal and different vectors
    points = [(40, [0.5, -0.25, 1.0])] * 30
    points += [(int(rng.integers(0, 50)), [float(v) for v in rng.integers(-2, 3, 3) / 4]) for _ in range(60)]
    found = topk.top_k(vectors(spark, [(k, x, 0, "s", 1) for k, x in points]), lambda v: v % 20 == 0, 7)
    assert sorted(tuple(r) for r in found.collect()) == by_row(points, 7)


@pytest.mark.parametrize("block, size, group, ties", [(4, 1 << 18, 4096, False), (16, 40, 3, True), (256, 7, 4096, True)])
def test_top_k_agrees_with_brute_force(spark, monkeypatch, block, size, group, ties):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SLICE", size)
    monkeypatch.setattr(topk, "GROUP", group)
    rng = np.random.default_rng(block)
    points = {k * 3: rng.integers(-2, 3, 5) / 64 if ties else rng.normal(0, 0.3, 5) for k in range(120)}
    points = {k: [float(np.float32(v)) for v in x] for k, x in points.items()}
    rows = [(k, x, 0, "s", 1) for k, x in points.items()]
    rows += [(7, None, 0, "s", 1), (20, [1.0, None], 0, "s", 1), (40, [math.nan, 1.0], 0, "s", 1), (80, [math.inf], 0, "s", 1), (None, [1.0], 0, "s", 1), (100, [], 0, "s", 1)]
    found = topk.top_k(vectors(spark, rows), lambda v: v % 20 == 0, 6).collect()
    whole = {k: [math.floor(64 * v) for v in x] for k, x in points.items()}
    expected = brute.top_k(whole, 6, lambda v: v % 20 == 0)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == expected


def test_top_k_of_little(spark):
    few = vectors(spark, [(0, [1.0, 2.0], 0, "s", 1), (1, [3.0], 0, "s", 1), (1, [3.0], 0, "s", 1)])
    found = topk.top_k(few, lambda v: v % 20 == 0, 5).collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 1, 64 * 192), (0, 2, 1, 64 * 192)]
    assert topk.top_k(few.limit(0), lambda v: v % 20 == 0, 5).count() == 0
    large = vectors(spark, [(0, [1e12], 0, "s", 1), (1, [1e5], 0, "s", 1), (2, [-1e5], 0, "s", 1)])
    assert [r.vec_id for r in topk.top_k(large, lambda v: v == 0, 5).orderBy("rank").collect()] == [1, 2]


def fuzzed(rng, text, edits):
    for _ in range(edits):
        k = rng.randrange(1, len(text) - 1)
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + "q" + text[k:], text[:k] + "q" + text[k + 1 :]])
    return text


def test_phrases_agree_with_brute_force(documents):
    rng = random.Random(6)
    words = ["CC", "by", "cc", "general", "public", "license", "all", "rights", "reserved", "é", "x1", "--"]
    docs = [(k, " .\n"[k % 3].join(rng.choice(words) for _ in range(rng.randrange(60)))) for k in range(300)]
    rows = licenses.scan(documents(*docs)).collect()
    for r in rows:
        found = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        assert found == brute.phrases(dict(docs)[r.doc_id], licenses.PHRASES)
        assert r.score == 1.0 if r.n_base else r.score < 1.0 or r.spans


def test_notices_with_edits_are_found(documents):
    rng, docs, expected = random.Random(7), [], {}
    for k, (notice, label) in enumerate(licenses.NOTICES.items()):
        for e in range(max(1, len(notice) // licenses.LETTERS_PER_EDIT) + 1):
            docs.append((100 * k + e, f"before, these words. {fuzzed(rng, notice, e).title()}; after"))
            expected[100 * k + e] = label
    found = {r.doc_id: r for r in licenses.scan(documents(*docs)).collect()}
    for doc_id, label in expected.items():
        assert label in [s.label for s in found[doc_id].spans], docs
        assert all(s.first_word >= 2 for s in found[doc_id].spans)
        assert found[doc_id].score > 0.8
    exact = found[0]
    assert [tuple(s) for s in exact.spans] == [("apache-2.0", 3, 10, 0)]
    plain = licenses.scan(documents((1, "a text about rights and public things"))).collect()[0]
    assert plain.spans == [] and plain.score == 0.0


def test_odd_rows_of_a_scan(documents):
    rows = licenses.scan(documents(*ODD, (8, "all rights reserved " * 20_000))).collect()
    assert len(rows) == len(ODD) + 1
    found = {r.doc_id: r for r in rows}
    assert (found[1].n_words, found[1].n_base, found[1].first_word, found[1].score) == (0, 0, None, 0.0)
    assert (found[8].n_base, found[8].last_word, len(found[8].spans)) == (20_000, 59_997, 20_000)
    assert licenses.scan(documents()).count() == 0


def test_notices_side_by_side_are_all_found(documents):
    texts = {
        1: ("all rights reservd all rights reserved", [(0, 2, 1), (3, 5, 0)]),
        2: ("all rights reserved all rights reservd", [(0, 2, 0), (3, 5, 1)]),
        3: ("released under the mit licens released under the mit license", [(0, 4, 1), (5, 9, 0)]),
        4: ("released under the mit license " * 3, [(0, 4, 0), (5, 9, 0), (10, 14, 0)]),
    }
    found = licenses.scan(documents(*((k, x[0]) for k, x in texts.items()))).collect()
    got = {r.doc_id: [(s.first_word, s.last_word, s.edits) for s in r.spans] for r in found}
    assert got == {k: x[1] for k, x in texts.items()}


def test_a_span_dropped_for_a_dropped_one_comes_back():
    held = {("a", 0, 4): 2, ("b", 4, 8): 1, ("c", 8, 12): 0}
    assert [(s["label"], s["edits"]) for s in licenses._closest(held)] == [("a", 2), ("c", 0)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_notices_within_the_bound_are_found_by_distance(documents):
    """Every planted notice with up to its number of edits, and nothing where all words are far."""
    rng = random.Random(9)
    rows, planted = [], {}
    for k in range(120):
        notice, label = rng.choice(list(licenses.NOTICES.items()))
        edits = rng.randrange(max(1, len(notice) // licenses.LETTERS_PER_EDIT) + 1)
        text = fuzzed(rng, notice, edits)
        rows.append((k, f"zq xv {text} qz vx"))
        planted[k] = (label, edit_distance(notice, text))
    for r in licenses.scan(documents(*rows, (900, "zq xv qz vx " * 9))).collect():
        if r.doc_id == 900:
            assert not r.spans
            continue
        label, distance = planted[r.doc_id]
        assert label in {s.label for s in r.spans} | set(r.base_labels)
        assert min(s.edits for s in r.spans) <= distance
