"""Fill-in-middle documents: cut at lines, mark the parts, exchange them by rotations in place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 7
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
CHANGED_PERCENT = 100  # of the documents that can be changed
SPM_PERCENT = 50  # of the changed ones
SWAP = 1 << 16  # bytes exchanged at a time


# ---- rotations ---------------------------------------------------------------------------


def reverse(view: np.ndarray, low: int, high: int) -> None:
    """Reverse view[low:high] in place, from both ends inwards, with bounded extra memory."""
    while high - low > 1:
        n = min(SWAP, (high - low) // 2)
        left = view[low : low + n].copy()
        view[low : low + n] = view[high - n : high][::-1]
        view[high - n : high] = left[::-1]
        low, high = low + n, high - n


def rotate(buffer: bytearray, low: int, cut: int, high: int) -> None:
    """Exchange buffer[low:cut] and buffer[cut:high] in place by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, low, cut)
    reverse(view, cut, high)
    reverse(view, low, high)


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends: behind its line feed, or with the text."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    return ends if text.endswith(b"\n") or not text else np.append(ends, len(text))


def arrange(text: bytes, first: int, second: int, form: str, marks: tuple[bytes, bytes, bytes]) -> bytearray:
    """The text cut at two byte places, marked, in the order of ``form``."""
    p, s, m = marks
    buffer = bytearray(text)
    buffer[second:second] = s  # from the right, so that places to the left stay valid
    buffer[first:first] = m
    buffer[0:0] = p
    middle = len(p) + first
    suffix = middle + len(m) + second - first
    rotate(buffer, 0 if form == "spm" else middle, suffix, len(buffer))
    return buffer


def restore_bytes(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text that :func:`arrange` was given: the rotation inverted, the marks taken out."""
    if form == "plain":
        return output
    p, s, m = marks
    buffer = bytearray(output)
    low = 0 if form == "spm" else buffer.find(s)
    rotate(buffer, low, buffer.find(p if form == "spm" else m, low), len(buffer))
    suffix, middle = buffer.rfind(s), buffer.find(m)
    del buffer[suffix : suffix + len(s)]
    del buffer[middle : middle + len(m)]
    del buffer[: len(p)]
    return bytes(buffer)


# ---- on Spark ----------------------------------------------------------------------------


def _lots(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers drawn by a document's id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    docs: DataFrame,
    seed: int = SEED,
    marks: tuple[str, str, str] = MARKS,
    changed_percent: int = CHANGED_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row of ``docs``.

    A text of n lines is cut behind a number of lines drawn for its prefix and another for its
    middle; ``form`` is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain. Plain
    are empty texts, texts that hold a mark, and 100 - ``changed_percent`` of 100 others; then the
    output is the text and the two lengths are null. All is drawn from the id: reruns agree, and
    rows with one id and one text, null ids included, come out alike, each as its own row. A null
    text counts as empty. Needs doc_id and text, of which other columns may bear any name. No mark
    may begin with the end of another. Texts are handled one at a time, whole, a long one within
    three times its size; nothing is shuffled, so a lost executor costs its own tasks only.
    """
    p, s, m = (x.encode() for x in marks)

    def changed(text: bytes, lots: tuple) -> tuple:
        n_ends = line_ends(text)
        n = len(n_ends)
        a, b, lot_form, lot_order = lots
        if not text or lot_form % 100 >= changed_percent or any(x in text for x in (p, s, m)):
            return n, "plain", None, None, text
        first, second = sorted((a % (n + 1), b % (n + 1)))
        places = np.concatenate([[0], n_ends])
        first, second = int(places[first]), int(places[second])
        form = "spm" if lot_order % 100 < spm_percent else "psm"
        starts = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80  # of code points
        prefix, middle = np.count_nonzero(starts[:first]), np.count_nonzero(starts[first:second])
        return n, form, prefix, middle, bytes(arrange(text, first, second, form, (p, s, m)))

    def rows(batches):
        for batch in batches:
            lots = zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)
            texts = batch.column(1).cast(pa.binary())
            found = [changed(t.as_py(), x) for t, x in zip(texts, lots, strict=True)]
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays[:4], arrays[4].cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    doc_id = F.col("doc_id").cast("long")
    drawn = [lot.alias(f"lot_{k}") for k, lot in enumerate(_lots(doc_id, seed))]
    return docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *drawn).mapInArrow(
        rows,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restore(changed: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Every row of :func:`transform` with ``text``, the document rebuilt from output and form."""
    codes = tuple(x.encode() for x in marks)

    def rows(batches):
        for batch in batches:
            forms = batch.column("form").to_pylist()
            outputs = batch.column("output").cast(pa.binary())
            found = [restore_bytes(x.as_py(), f, codes) for x, f in zip(outputs, forms, strict=True)]
            text = pa.array(found, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, text], [*batch.schema.names, "text"]
            )

    return changed.mapInArrow(rows, T.StructType([*changed.schema.fields, T.StructField("text", T.StringType())]))
