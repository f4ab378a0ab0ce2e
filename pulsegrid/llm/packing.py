"""Pack documents into sequences without crossing documents: pieces of power-of-two length."""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import Words, chunks

CONTEXT = 4096
END_ID = 2
REMEMBERED = 3_000_000  # words whose ids a worker keeps; then it starts anew
MARKS = ".,;:!?"
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, bucket int, offset long, ids binary"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of whole texts, word by word.

    This kind of tokenizer drops white space and never joins across it, so a text's ids are
    those of its blank-separated words. Each word is encoded once and found again by its 64-bit
    hash. Most words are letters with at most a mark behind them; those need no normalising but
    lower case and no pattern to split them, so a copy of the tokenizer without these steps
    encodes them many at a time, each word ending in a word-end token. All others go to the
    tokenizer as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        parts = json.loads(self.whole.to_str())
        self.plain = Tokenizer.from_str(json.dumps(parts | {"normalizer": None}))
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.at = self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def encode_plain(self, words: list[str]) -> list[list[int]]:
        joined = [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)]
        found = self.plain.encode_batch_fast(joined, add_special_tokens=False)
        ids = [i for x in found for i in x.ids]
        ends = np.flatnonzero(self.last[ids]).tolist() if ids else []
        assert len(ends) == len(words), "a word must end in exactly one word-end token"
        return [ids[a + 1 : b + 1] for a, b in zip([-1, *ends], ends, strict=False)]

    def encode(self, words: list[str]) -> list[list[int]]:
        plain: dict[str, list[int] | None] = {}
        shapes: list[tuple[str, str] | None] = []
        for word in words:
            mark = word[-1] if word[-1] in MARKS else ""
            body = (word[:-1] if mark else word).lower()
            if body.isalpha() and (body.isascii() or max(body) < "\u0180"):
                plain[body] = None  # letters that need no composing
                shapes.append((body, mark))
            else:
                shapes.append(None)
        plain.update(zip(plain, self.encode_plain(list(plain)), strict=True))
        odd = [w for w, shape in zip(words, shapes, strict=True) if shape is None]
        found = self.whole.encode_batch_fast([*odd, *MARKS], add_special_tokens=False)
        others = iter(found)
        ids = [next(others).ids if s is None else plain[s[0]] for s in shapes]
        marks = {mark: x.ids for mark, x in zip(MARKS, others, strict=True)} | {"": []}
        return [x + marks[s[1]] if s else x for x, s in zip(ids, shapes, strict=True)]

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = self.encode(words)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        at = len(self.pool) + np.cumsum(size) - size
        fresh = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
        self.pool = np.concatenate([self.pool, fresh])
        all_hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(all_hashes)
        self.hashes = all_hashes[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and where those of each begin."""
        words = Words(data, offsets)
        if not len(words.starts):
            return self.pool[:0], np.zeros(len(offsets), np.int64)
        distinct, example, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self.forget()
        new = ~np.isin(distinct, self.hashes, assume_unique=True)
        if new.any():
            raw = data.tobytes()
            spans = zip(words.starts[example[new]], words.ends[example[new]], strict=True)
            self.learn(distinct[new], [raw[a:b].decode() for a, b in spans])
        found = np.searchsorted(self.hashes, distinct)
        at, size = self.at[found][which], self.size[found][which]
        edges = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(at - edges[:-1], size) + np.arange(edges[-1])]
        return ids, edges[words.first]


def piece_lengths(n: int, context: int) -> list[int]:
    """n as full contexts and then its binary digits, largest first."""
    rest = n % context
    return [context] * (n // context) + [
        1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1
    ]


def pieces(
    docs: DataFrame, context: int = CONTEXT, tokenizer: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Pieces of every document: where each starts, its length and its ids (uint32, little-endian).

    ``context`` is a power of two. Each piece is a sequence of its own, so there is no padding
    and no attention across documents; ``bucket`` is the binary logarithm of the length, and
    batches are drawn from one bucket. Needs doc_id and text only. A null or empty text is the
    end id alone. Repeated rows are packed each for themselves. Texts are read whole, some
    megabytes at a time; nothing is shuffled, since no sequence needs a second document.
    """
    if context & (context - 1):
        raise ValueError("context must be a power of two")
    path = tokenizer or default_tokenizer()
    last = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode = WordIds(path)
        for batch in batches:
            names_of = batch.column(0).to_pylist()
            for row, data, offsets in chunks(batch.column(1)):
                columns: list[list] = [[] for _ in range(7)]
                ids, edges = encode(data, offsets)
                flat = ids.astype("<u4").tobytes()
                for k in range(len(offsets) - 1):
                    own, start = memoryview(flat[4 * edges[k] : 4 * edges[k + 1]] + last), 0
                    tokens = len(own) // 4
                    for n in piece_lengths(tokens, context):
                        values = (names_of[row + k], start, n, tokens, n.bit_length() - 1, 0)
                        for column, value in zip(columns, values, strict=False):
                            column.append(value)
                        columns[6].append(bytes(own[4 * start : 4 * (start + n)]))
                        start += n
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                names = ["doc_id", "start", "length", "doc_tokens", "bucket", "offset", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    cut_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut_docs.mapInArrow(cut, PIECES).withColumn(
        "sequence_id", F.monotonically_increasing_id()
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length, so that a reader draws batches of equal length."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)
