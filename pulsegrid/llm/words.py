"""Words of whole Arrow batches: their places and 64-bit hashes, without a loop over texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 2**64))
CHUNK = 4 << 20  # bytes of text looked at together; one text longer than that is its own chunk

#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII digits, lower-case letters and all bytes beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a 64-bit value over all others (one-to-one)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            factors = np.full(n, MULTIPLIER)
            factors[0] = 1
            cls.up = np.cumprod(factors, dtype=np.uint64)
            factors[1:] = INVERSE
            cls.down = np.cumprod(factors, dtype=np.uint64)
        return cls.up[:n], cls.down[:n]


def chunks(texts: pa.Array, limit: int = CHUNK):
    """(first row, bytes, offsets) of consecutive runs of texts; null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), n)
        yield row, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


class Words:
    """Words of some texts: byte range of each, and the number of words before each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = NOT_BLANK):
        inside = table[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        full = offsets[1:] > offsets[:-1]
        before[offsets[:-1][full]] = False
        after[offsets[1:][full] - 1] = False
        self.data = data
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = Powers.upto(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return mixed((total[self.ends] - total[self.starts]) * down[self.starts])

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def whole(self, n: int) -> np.ndarray:
        """Whether n words from each word on lie in its text."""
        last = np.repeat(self.first[1:], self.counts)
        return np.arange(len(self.starts)) + n <= last


def runs(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n hashes from each place on (as many values as whole runs)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(h) - n + 1, seed, np.uint64)
    for k in range(n):
        total = total * MULTIPLIER + h[k : len(h) - n + 1 + k]
    return mixed(total)


def lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """List column of n rows: the values of each owner; owners ascend."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
