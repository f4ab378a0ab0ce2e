"""Fill-in-middle against plain slicing, and its exact round trip."""

import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.llm import infill

from .conftest import ODD

CODES = tuple(x.encode() for x in infill.MARKS)


def plain(doc_id, text):
    """(n, form, prefix length, middle length, output) by slicing lists of lines."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    lots = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in infill.MARKS):
        return len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in lots[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if lots[3] % 100 < 50:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ROWS = [
    *ODD,
    *((k, "eins\nzwei äöü\n\ndrei 漢字 ☃") for k in range(10, 40)),
    (50, "holds a <M> mark\nof its own"),
    (51, "ends with a mark's start <\n<P\n<S"),
    (52, "\n\n\n"),
    (53, "one\r\ntwo three\n"),
    (54, "line\n" * 100_000),
    (-1, "a negative id\nwith lines"),
]


def test_texts_are_cut_marked_and_rebuilt(documents):
    found = infill.restore(infill.transform(documents(*ROWS))).collect()
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in found]
    want = [(r[0], *plain(r[0], r[1]), r[1] or "") for r in ROWS]
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in want} == {"plain", "spm", "psm"}


def test_shares_of_forms_are_parameters(documents):
    docs = documents(*((k, "a\nb\nc\n") for k in range(400)))
    forms = dict(
        infill.transform(docs, changed_percent=50, spm_percent=0).groupBy("form").count().collect()
    )
    assert set(forms) == {"plain", "psm"} and 150 < forms["plain"] < 250


def test_an_empty_table_gives_no_rows(documents, spark):
    empty = documents(*ODD).where(F.lit(False))
    assert infill.restore(infill.transform(empty)).count() == 0


@given(st.binary(max_size=60), st.data())
def test_rotations_exchange_and_invert(text, data):
    low, cut, high = sorted(data.draw(st.integers(0, len(text))) for _ in range(3))
    buffer = bytearray(text)
    infill.rotate(buffer, low, cut, high)
    assert buffer == text[:low] + text[cut:high] + text[low:cut] + text[high:]
    infill.rotate(buffer, low, low + high - cut, high)
    assert buffer == text


@pytest.mark.parametrize("form", ["psm", "spm"])
@pytest.mark.parametrize("size", [0, 3, infill.SWAP * 2 + 1, infill.SWAP * 5])
def test_long_blocks_are_exchanged_piece_by_piece(form, size):
    text = (b"0123456789" * (size // 10 + 1))[:size]
    first, second = size // 3, size // 2
    p, m, s = text[:first], text[first:second], text[second:]
    want = b"<S>" + s + b"<P>" + p + b"<M>" + m if form == "spm" else b"<P>" + p + b"<S>" + s + b"<M>" + m
    output = bytes(infill.arrange(text, first, second, form, CODES))
    assert output == want and infill.restore_bytes(output, form, CODES) == text
