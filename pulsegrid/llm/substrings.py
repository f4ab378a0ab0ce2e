"""Remove word windows that occurred before: candidates double in length level by level."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import Words, chunks, mixed, runs

WINDOW = 20
DOUBLINGS = 1  # the first level is window / 2**DOUBLINGS words long
NO_ID = -(2**62)  # ids lie above; keys of texts without an id lie at or below, one per text
RESULT = "doc_id long, n_words long, n_removed long, kept string"


def _owned(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A hash together with the text it belongs to."""
    return mixed(h + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _lowest(h: np.ndarray, span: int) -> np.ndarray:
    """Smallest of the ``span`` values from each place on, by doubling."""
    done = 1
    while done < span:
        step = min(done, span - done)
        h = np.minimum(h[:-step], h[step:])
        done += step
    return h


def _listed(column: pa.Array, row: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of n rows of a list column, and whose they are; null is empty."""
    part = column.slice(row, n)
    offsets = part.offsets.to_numpy()
    values = part.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
    return values, np.repeat(np.arange(n), np.diff(offsets))


class _Level:
    """One chunk of texts at one level: its windows and the lowest shorter run in each."""

    def __init__(self, data, offsets, window: int):
        self.words = Words(data, offsets)
        self.hashes = self.words.hashes()
        self.window = window
        self.starts = np.flatnonzero(self.words.whole(window))
        self.row = self.words.text_of_word()[self.starts]

    def lowest(self, length: int) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        return _lowest(runs(self.hashes, length), self.window - length + 1)[self.starts]

    def surviving(self, length: int, values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Windows whose lowest run of ``length`` words is among the values of their text."""
        return np.isin(_owned(self.lowest(length), self.row), _owned(values, owner))


def _distinct(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of the distinct (text, hash) pairs."""
    if not len(h):
        return np.zeros(0, np.int64)
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    places = np.flatnonzero(new)
    return places[np.unique(_owned(h[places], row[places]), return_index=True)[1]]


def _copied(batch, row: int, n: int) -> np.ndarray:
    """Which of n rows have the text of an earlier document."""
    texts, whose = _listed(batch.column("copied"), row, n)
    own = batch.column("digest").to_numpy()[row : row + n].view(np.uint64)
    found = np.zeros(n, bool)
    found[whose[texts == own[whose]]] = True
    return found


def _emit(window: int, length: int, before: int | None):
    """Per text, its distinct lowest runs of ``length`` words in windows that still count.

    A window repeats only if its lowest run does, and equal windows have the same lowest run, so
    about two in (window - length + 2) runs stand for all of them and none is missed.
    """

    def emit(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            digests = batch.column("digest").to_numpy()
            for row, data, offsets in chunks(batch.column("text")):
                level = _Level(data, offsets, window)
                h, owner = level.lowest(length), level.row
                second = runs(level.hashes, window, 1)[level.starts] if length == window else h
                if before:
                    values, whose = _listed(batch.column("hs"), row, len(offsets) - 1)
                    alive = level.surviving(before, values, whose)
                    alive &= ~_copied(batch, row, len(offsets) - 1)[owner]
                    h, owner, second = h[alive], owner[alive], second[alive]
                at = _distinct(h, owner)
                columns = {"h": h[at].view(np.int64), "key": keys[row + owner[at]]}
                if length < window:
                    columns["digest"] = digests[row + owner[at]]
                else:
                    columns["g"] = (second[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_pydict(columns)

    return emit


def _remove(window: int):
    """Texts without the windows that began before: in an earlier text (listed) or this one."""

    def remove(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for row, data, offsets in chunks(batch.column("text")):
                n = len(offsets) - 1
                level = _Level(data, offsets, window)
                words = level.words
                own = _owned(level.lowest(window), level.row)
                goes = np.ones(len(own), bool)
                goes[np.unique(own, return_index=True)[1]] = False
                goes |= np.isin(own, _owned(*_listed(batch.column("hs"), row, n)))
                goes |= _copied(batch, row, n)[level.row]
                edge = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(edge, level.starts[goes], 1)
                np.add.at(edge, level.starts[goes] + window, -1)
                kept = np.cumsum(edge[:-1]) == 0

                # every kept word with one blank behind it, but for the last of a text
                text = words.text_of_word()[kept]
                inner = np.ones(len(text), bool)
                inner[:-1] = text[1:] == text[:-1]
                inner[-1:] = False
                starts, ends = words.starts[kept], words.ends[kept]
                data = data.copy()
                data[ends[inner]] = 0x20
                span = np.zeros(len(data) + 1, np.int8)
                span[starts] += 1
                span[ends + inner] -= 1
                stays = np.cumsum(span[:-1], dtype=np.int8) > 0
                size = np.zeros(len(data) + 1, np.int64)
                np.cumsum(stays, out=size[1:])
                removed = words.counts - np.bincount(text, minlength=n)
                kept_text = pa.Array.from_buffers(
                    pa.large_string(),
                    n,
                    [None, pa.py_buffer(size[offsets]), pa.py_buffer(data[stays])],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, n),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(removed.astype(np.int64)),
                        kept_text.cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW, doublings: int = DOUBLINGS) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words of every document, joined by one blank.

    A word goes if a window of ``window`` words over it also starts earlier: in a document with
    a smaller id, or before in the same one. Windows are judged on the input. Only runs that
    repeat (between different texts) at one length are looked at in twice that length, down from ``window`` through
    ``doublings`` halvings.

    Needs doc_id and text; no other column is read. A null text has no words. A null id counts
    as the smallest; an id of -2**62 or less is an error. Rows with equal ids, or without one, do
    not remove each other's words. An empty table gives no rows. Equality is that of 96 bits of hash. Per document only lists of its own hashes come
    together; windows shared by many documents are counted map-side and joined, never gathered.
    """
    if window % 2**doublings:
        raise ValueError("window must be divisible by 2**doublings")
    lengths = [window >> k for k in range(doublings, -1, -1)]
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _key(F.col("doc_id").cast("long"), F.col("text")).alias("key"),
        F.xxhash64("text").alias("digest"),
        "text",
    )
    copies = _copies(keyed)
    source, before = keyed, None
    for length in lengths[:-1]:
        rows = source.mapInArrow(_emit(window, length, before), "h long, key long, digest long")
        repeated = (
            rows.groupBy("h")
            .agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
            .where("x <> y")
            .select("h")
        )
        lists = _listed_by_key(rows.select("h", "key").join(repeated, "h"), copies)
        source, before = _with_lists(keyed, lists.where(F.size("hs") > 0), "inner"), length
    rows = source.mapInArrow(_emit(window, window, before), "h long, key long, g int")
    first = rows.groupBy("h", "g").agg(F.min("key").alias("first"))
    foreign = rows.join(first, ["h", "g"]).where(_later("key", "first"))
    return _with_lists(keyed, _listed_by_key(foreign, copies), "left").mapInArrow(
        _remove(window), RESULT
    )


def _key(doc_id: Column, text: Column) -> Column:
    """What lists are kept by: the id, or for a text without one a number of its own below all
    ids, so that the rows without an id never come together as one key."""
    own = F.lit(NO_ID) - F.pmod(F.xxhash64(text), F.lit(2**62))
    low = F.raise_error(F.lit("substring dedup needs ids above -2**62")).cast("long")
    key = F.when(doc_id.isNull(), own).when(doc_id <= NO_ID, low).otherwise(doc_id)
    # never null, and known to be: joins then add no filter, and the texts are shuffled by it once
    return F.coalesce(key, F.lit(NO_ID))


def _later(key: str, first: str) -> Column:
    """Whether a document comes after another one; those without an id are all equally early."""
    floor = F.lit(NO_ID)
    return F.greatest(key, floor) > F.greatest(first, floor)


def _copies(keyed: DataFrame) -> DataFrame:
    """key, digest of the documents that have the whole text of an earlier one: all of their
    windows began before, and they begin none that the earlier one does not."""
    texts = keyed.select("key", "digest", F.xxhash64(F.lit(1), "text").alias("second"))
    first = texts.groupBy("digest", "second").agg(F.min("key").alias("first"))
    return (
        texts.join(first, ["digest", "second"])
        .where(_later("key", "first"))
        .select("key", "digest")
    )


def _listed_by_key(hashes: DataFrame, copies: DataFrame) -> DataFrame:
    """Per document id its hashes and the texts of its rows that are copies."""
    none = F.lit(None).cast("long")
    return (
        hashes.select("key", "h", none.alias("digest"))
        .unionByName(copies.select("key", none.alias("h"), "digest"))
        .groupBy("key")
        .agg(F.collect_list("h").alias("hs"), F.collect_set("digest").alias("copied"))
    )


def _with_lists(keyed: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    return keyed.join(lists, "key", how).select("doc_id", "key", "digest", "text", "hs", "copied")
