"""Find licence notices: exact phrases, and short notices within a bounded number of edits."""

from __future__ import annotations

import bisect
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import ALPHANUMERIC, LOWER, Words, chunks

#: Phrases that are searched word by word, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Short notices that are searched with edits, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}
LETTERS_PER_EDIT = 12  # a notice may differ in one edit for so many of its letters

SPAN = "struct<label: string, first_word: long, last_word: long, edits: int>"
FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    f"base_labels array<string>, spans array<{SPAN}>, score double"
)


class Notices:
    """The notices as seeds and bounded patterns.

    A notice within e edits holds one of its e + 1 pieces unchanged (pigeonhole), so the pieces
    are searched exactly and all together, and the pattern is tried only around a piece.
    """

    def __init__(self, notices: dict[str, str], letters_per_edit: int):
        import ahocorasick
        import regex

        self.patterns = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, label) in enumerate(notices.items()):
            edits = max(1, len(notice) // letters_per_edit)
            cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(notice[a:b], []).append((k, a))
            pattern = regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}")
            self.patterns.append((pattern, len(notice), edits, label))
        self.seeds = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.seeds.add_word(piece, (len(piece), owners))
        self.seeds.make_automaton()

    def search(self, text: str):
        """(start, end, edits, notice's length, label) of the matches in lines of ``text``."""
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (size, owners) in self.seeds.iter(text):
            for k, offset in owners:
                _, length, edits, _ = self.patterns[k]
                at = end + 1 - size - offset
                windows.setdefault(k, []).append((max(0, at - edits), at + length + edits))
        for k, spans in windows.items():
            pattern, length, edits, label = self.patterns[k]
            merged: list[list[int]] = []
            for a, b in sorted(spans):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            for a, b in merged:
                base = a
                for line in text[a:b].split("\n"):
                    for m in _all_matches(pattern, line, length - edits):
                        yield base + m.start(), base + m.end(), sum(m.fuzzy_counts), length, label
                    base += len(line) + 1


def _all_matches(pattern, line: str, shortest: int):
    """Matches that do not overlap: the best of the line, and those of what is before and behind it."""
    parts = [(0, len(line))]
    while parts:
        low, high = parts.pop()
        match = pattern.search(line, low, high) if high - low >= shortest else None
        if match:
            yield match
            parts += [(low, match.start()), (match.end(), high)]


def _joined(data: np.ndarray, words: Words) -> tuple[str, np.ndarray]:
    """The words one blank apart, a line for each text that has any, and where each word starts.

    A character stands for a byte, so that places in the text are places in the bytes.
    """
    size = words.ends - words.starts
    starts = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    inside = np.repeat(words.starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out[np.repeat(starts - words.starts, size) + inside] = data[inside]
    lasts = words.first[1:][words.counts > 0] - 1
    out[starts[lasts] + size[lasts]] = 0x0A
    return out.tobytes().decode("latin-1"), starts


def _places(text: str, phrase: str) -> list[int]:
    """Where a phrase stands between whole words."""
    found, at = [], text.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or text[at - 1] in " \n") and text[end] in " \n":
            found.append(at)
        at = text.find(phrase, at + 1)
    return found


def _closest(held: dict[tuple[str, int, int], int]) -> list[dict]:
    """The spans of a text in order, but for those that overlap a span with fewer edits that stays."""
    kept: list[dict] = []
    taken: set[int] = set()  # words of spans with fewer edits
    for edits, group in groupby(sorted(held.items(), key=lambda x: x[1]), key=lambda x: x[1]):
        free = [key for key, _ in group if taken.isdisjoint(range(key[1], key[2] + 1))]
        for label, first, last in free:
            kept.append({"label": label, "first_word": first, "last_word": last, "edits": edits})
            taken.update(range(first, last + 1))
    return sorted(kept, key=lambda x: (x["first_word"], x["edits"], x["label"], x["last_word"]))


def _scan(phrases: dict[str, str], notices: dict[str, str], letters_per_edit: int):
    def scan(batches):
        known = Notices(notices, letters_per_edit)
        for batch in batches:
            for row, data, offsets in chunks(batch.column("text")):
                n = len(offsets) - 1
                data = LOWER[data]
                words = Words(data, offsets, ALPHANUMERIC)
                text, starts = _joined(data, words)
                places: dict[int, list[int]] = {}
                labels: dict[int, set[str]] = {}
                spans: dict[int, dict] = {}
                scores = np.zeros(n)

                def word(at: int, starts=starts, words=words) -> tuple[int, int]:
                    """Which text a place lies in, and its word there."""
                    k = bisect.bisect_right(starts, at) - 1
                    owner = bisect.bisect_right(words.first, k) - 1
                    return owner, k - int(words.first[owner])

                for phrase, label in phrases.items():
                    for at in _places(text, phrase):
                        owner, place = word(at)
                        places.setdefault(owner, []).append(place)
                        labels.setdefault(owner, set()).add(label)
                        scores[owner] = 1.0
                for start, end, edits, length, label in known.search(text):
                    # a match may begin or end on a blank
                    start += text[start] == " "
                    end -= text[end - 1] == " "
                    owner, first = word(start)
                    last = word(end - 1)[1]
                    key = (label, first, last)
                    held = spans.setdefault(owner, {})
                    held[key] = min(edits, held.get(key, edits))
                    scores[owner] = max(scores[owner], 1 - edits / length)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, n),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array([len(places.get(k, ())) for k in range(n)], pa.int64()),
                        pa.array([min(places[k]) if k in places else None for k in range(n)], pa.int64()),
                        pa.array([max(places[k]) if k in places else None for k in range(n)], pa.int64()),
                        pa.array([sorted(labels.get(k, ())) for k in range(n)], pa.list_(pa.string())),
                        pa.array(
                            [_closest(spans.get(k, {})) for k in range(n)],
                            pa.list_(
                                pa.struct(
                                    {
                                        "label": pa.string(),
                                        "first_word": pa.int64(),
                                        "last_word": pa.int64(),
                                        "edits": pa.int32(),
                                    }
                                )
                            ),
                        ),
                        pa.array(scores),
                    ],
                    [x.split()[0] for x in FOUND.split(", spans")[0].split(", ")] + ["spans", "score"],
                )

    return scan


def scan(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    letters_per_edit: int = LETTERS_PER_EDIT,
) -> DataFrame:
    """Licence phrases and notices of every document.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower
    case. ``n_base`` counts the places where a phrase's words stand one after the other, with
    the first and the last of these places and the labels found; ``spans`` are the notices
    within one edit (at least) for every ``letters_per_edit`` letters (an edit inserts, drops or changes
    one byte), with their first and last word; of overlapping
    ones those with the fewest edits. ``score`` is 1 for a phrase, otherwise the
    largest share of a notice that is unchanged, or 0.

    Needs doc_id and text. A null or empty text has no words, no places, no labels and score 0.
    Repeated rows are reported each. Texts are scanned whole, nothing is shuffled.
    """
    phrases = PHRASES if phrases is None else phrases
    notices = NOTICES if notices is None else notices
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(phrases, notices, letters_per_edit), FOUND
    )
