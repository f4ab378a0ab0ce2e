import hashlib
import random

import numpy as np
import pytest

from pulsegrid.llm import fingerprints as fp
from tests.llm.conftest import ODD


def prose(rng, n):
    return "".join(rng.choice("abcdefghij klmno pq rs") for _ in range(n))


def test_a_walk_does_not_depend_on_its_company():
    rng = random.Random(1)
    texts = [prose(rng, n) for n in [0, 1, 2, 5, 64, 65, 128, 129, 300, 4000] * 6] + ["é\ud800\U0001f600" * 9]
    walk = fp.Walk()
    together = walk(texts)
    assert together == [walk([t])[0] for t in texts]
    assert all(fp.parsed(fp.written(x)) == x for x in together)
    assert max(len(x[1]) for x in together) < 2 * fp.SAMPLES


def test_likeness_follows_edits():
    rng, walk = random.Random(2), fp.Walk()
    few, many = [], []
    for _ in range(60):
        text = prose(rng, rng.randrange(300, 5000))
        other = prose(rng, len(text))
        places = [rng.randrange(len(text)) for _ in range(2)]
        edited = "".join("" if k in places else c for k, c in enumerate(text))
        cut = text[: len(text) * 3 // 4] + other[: len(text) // 4]
        a, b, c, d = walk([text, edited, cut, other])
        assert walk.likeness(a, a) == 1.0 and walk.likeness(a, b) == walk.likeness(b, a)
        few.append(walk.likeness(a, b))
        many.append(walk.likeness(a, d))
        assert 0.55 < walk.likeness(a, c) < 0.95
    assert np.median(few) > 0.9 and max(many) < 0.3
    empty, short = walk(["", "abc"])
    assert walk.likeness(empty, empty) == 1.0 and walk.likeness(empty, short) == 0.0


def test_bands_meet_across_levels():
    rng, walk, met = random.Random(3), fp.Walk(), 0
    for _ in range(40):
        text = prose(rng, 512)  # one more character is another level
        a, b = walk([text, text + "x"])
        assert a[0] + 1 == b[0]
        met += bool(set(walk.bands(a)) & set(walk.bands(b)))
    assert met > 35


@pytest.mark.parametrize("where", ["start", "middle", "end", "scattered"])
def test_bands_find_edits_anywhere(where):
    rng, walk = random.Random(7), fp.Walk()
    texts, edited = [], []
    for _ in range(500):
        n = rng.randrange(150, 3000)
        text, w = prose(rng, n), int(n * rng.uniform(0.1, 0.2))
        at = {"start": 0, "middle": (n - w) // 2, "end": n - w}.get(where)
        if at is None:
            other = list(text)
            for k in rng.sample(range(n), n // 50):
                other[k] = "Z"
            other = "".join(other)
        else:
            other = text[:at] + prose(rng, w) + text[at + w :]
        texts.append(text)
        edited.append(other)
    met = [
        bool(set(walk.bands(a)) & set(walk.bands(b)))
        for a, b in zip(walk(texts), walk(edited), strict=True)
        if fp.LIKE <= walk.likeness(a, b) <= 0.88
    ]
    assert len(met) > 50 and np.mean(met) >= 0.9


def test_next_document_and_edited_text(documents, spark):
    rng = random.Random(4)
    docs = [(k * 7 % 500, prose(rng, rng.randrange(0, 400))) for k in range(300)]
    order = sorted(docs)
    after = {a[0]: (a[1], b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True)}
    walk = fp.Walk()
    rows = fp.fingerprints(documents(*docs)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text, following = after[r.doc_id]
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = walk([text, edited, following])
        assert (r.fingerprint, r.edited_fingerprint) == (fp.written(a), fp.written(b))
        assert (r.near_edited, r.near_next) == (walk.likeness(a, b), walk.likeness(a, c))


def test_copies_find_the_earliest(documents):
    rng = random.Random(5)
    text, other = prose(rng, 2000), prose(rng, 2000)
    near = text[:1000] + "Z" + text[1000:]
    rows = fp.with_earlier(documents((3, text), (5, other), (8, text), (9, near))).collect()
    assert {r.doc_id: r.near_id for r in rows} == {3: 3, 5: 5, 8: 3, 9: 3}


@pytest.mark.parametrize("block", [1024, 3])
def test_copies_meet_behind_a_head_that_is_not_alike(documents, monkeypatch, block):
    monkeypatch.setattr(fp, "BLOCK", block)
    rng = random.Random(6)
    head = prose(rng, 1200)
    texts = {1: head + prose(rng, 800)}
    for first in (100, 200, 300):  # groups behind one head passage
        body = prose(rng, 800)
        for k in range(6):
            at = 1200 + rng.randrange(700)
            whole = head + body
            texts[first + k] = whole[:at] + "Z" + whole[at:]
    # a chain: each is alike to the one before it, the last not to the first
    chain = [prose(rng, 2000)]
    for k in range(1, 4):
        at = 2000 - 220 * k
        chain.append(chain[-1][:at] + prose(rng, 220) + chain[-1][at + 220 :])
    texts |= {400 + k: t for k, t in enumerate(chain)}
    texts |= {500: texts[203], 501: texts[1]}
    walk = fp.Walk()
    prints = {k: walk([t])[0] for k, t in texts.items()}
    bands = {k: set(walk.bands(x)) for k, x in prints.items()}
    expected = {
        k: min(e for e in texts if e <= k and bands[e] & bands[k] and walk.likeness(prints[e], prints[k]) >= fp.LIKE)
        for k in texts
    }
    assert expected[105] == 100 and expected[203] == 200  # not alike to 1, alike to each other
    rows = fp.with_earlier(documents(*texts.items())).collect()
    assert {r.doc_id: r.near_id for r in rows} == expected


def test_odd_rows(documents):
    rows = fp.with_earlier(documents(*ODD)).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id: r.n_chars for r in rows}[6] == 250_000
    alone = fp.with_earlier(documents((4, "only one"))).collect()[0]
    assert alone.near_next == 1.0 and alone.near_id == 4
    assert fp.with_earlier(documents()).count() == 0
