import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm.words import ALPHANUMERIC, LOWER, Words, chunks, runs
from tests.llm import brute

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 \n\té.\x00", max_size=12)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 20))
def test_words_of_chunks(texts, limit):
    found = []
    for row, data, offsets in chunks(pa.array(texts, pa.string()), limit):
        assert row == len(found)
        words = Words(data, offsets)
        hashes = words.hashes()
        for k in range(len(offsets) - 1):
            span = slice(words.first[k], words.first[k + 1])
            spans = zip(words.starts[span], words.ends[span], strict=True)
            found.append(([data[a:b].tobytes().decode() for a, b in spans], hashes[span].tolist()))
    assert [w for w, _ in found] == [brute.WORD.findall(t or "") for t in texts]
    names = {w: h for row in found for w, h in zip(*row, strict=True)}
    assert all(names[w] == h for row in found for w, h in zip(*row, strict=True))
    assert len(set(names.values())) == len(names)


@given(st.text(max_size=30))
def test_letters_and_digits(text):
    for _, data, offsets in chunks(pa.array([text])):
        words = Words(LOWER[data], offsets, ALPHANUMERIC)
        assert words.counts.tolist() == [len(brute.ALNUM.findall(text.translate(brute.LOWER)))]


def test_runs_name_sequences():
    h = np.array([1, 2, 3, 1, 2, 3, 4], np.uint64)
    found = runs(h, 3).tolist()
    assert found[0] == found[3] and len(set(found)) == 4 and len(runs(h, 8)) == 0
