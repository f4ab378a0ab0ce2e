import hashlib
import random

import pytest

from pulsegrid.llm import substrings
from tests.llm import brute
from tests.llm.conftest import ODD


def result(frame):
    return {
        r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
        for r in frame.collect()
    }


@pytest.mark.parametrize("doublings", [0, 1, 2])
def test_agrees_with_brute_force(documents, doublings):
    rng = random.Random(doublings)
    passage = [str(rng.randrange(30)) for _ in range(60)]
    docs = []
    for k in range(60):
        words = [str(rng.randrange(4 if k % 7 == 0 else 500)) for _ in range(rng.randrange(90))]
        if k % 3 == 0:
            at = rng.randrange(40)
            words[len(words) // 2 : 0] = passage[at : at + rng.randrange(30)]
        docs.append((k, "\n ".join(words)))
    docs += [(100 + k, docs[k][1]) for k in range(0, 60, 5)]
    docs += [(200, " ".join(passage * 3)), (201, "x " * 100), (202, None), (203, "")]
    found = result(substrings.remove_repeats(documents(*docs), 12 if doublings == 2 else 10, min(doublings, 1 if doublings < 2 else 2)))
    assert found == brute.repeats(docs, 12 if doublings == 2 else 10)


def test_odd_rows(documents):
    rows = substrings.remove_repeats(documents(*ODD)).collect()
    assert len(rows) == len(ODD)
    found = {r.doc_id: (r.n_words, r.n_removed) for r in rows}
    assert found == {None: (5, 0), 1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (1, 0), 5: (3, 0), 6: (50_000, 49_999)}


def test_rows_of_one_id_keep_each_other(documents):
    text = " ".join(map(str, range(30)))
    rows = substrings.remove_repeats(documents((1, text), (1, text), (2, text))).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, 30)]


def test_texts_without_an_id_are_keys_of_their_own(documents):
    """They come before every id and keep each other's words, and no key gathers all of them."""
    passage = " ".join(map(str, range(25)))
    texts = [f"{'a%d ' % k * 3}{passage}" for k in range(40)]
    frame = documents(*[(None, x) for x in texts], (None, texts[0]), (-5, texts[3]), (7, f"b {passage}"))
    rows = substrings.remove_repeats(frame).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(-5, 28)] + [(0, 0)] * 41 + [(7, 25)]
    keys = frame.select(substrings._key(frame.doc_id, frame.text).alias("key")).distinct()
    assert keys.where(f"key <= {substrings.NO_ID}").count() == 40


def test_an_id_below_the_range_is_an_error(documents):
    with pytest.raises(Exception, match="ids above"):
        substrings.remove_repeats(documents((-(2**62), "a b"))).collect()


def test_empty_table(documents):
    assert substrings.remove_repeats(documents()).count() == 0
