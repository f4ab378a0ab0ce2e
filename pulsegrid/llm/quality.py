"""Quality scores by compression: which labelled text makes a document smaller as a dictionary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm import labelled

SAMPLE = 8_000  # most labelled documents the model is fitted on: half for text, half to calibrate
DICTIONARY = 256 << 10  # characters of a dictionary, shared out among its documents
CHUNK = 1024  # bytes compressed at a time; a longer run would lean on itself, not the dictionary
LEVEL = 5
KEEP = 0.3
SCORED = "doc_id long, score double"


class Compressors:
    """Sizes of texts under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.kinds = []
        for text in (good, bad):
            held = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.kinds.append(
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=held,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                ).compress
            )

    def difference(self, text: str) -> float:
        """Bytes that the good dictionary saves over the bad one, by bytes of the whole text."""
        data = text.encode("utf-8", "surrogatepass")
        good, bad = self.kinds
        saved = 0
        for at in range(0, len(data), CHUNK):
            part = data[at : at + CHUNK]
            saved += len(bad(part)) - len(good(part))
        return saved / max(1, len(data))


class Model:
    """The two dictionaries and the curve from size differences to scores."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = good, bad
        self.knots, self.shares = labelled.rising(np.zeros(0), np.zeros(0))

    def calibrate(self, differences: np.ndarray, y: np.ndarray) -> None:
        self.knots, self.shares = labelled.rising(differences, y)

    def scores(self, differences: list[float]) -> np.ndarray:
        return np.interp(differences, self.knots, self.shares)

    def differences(self, frame: DataFrame, key: str, kind: str) -> DataFrame:
        good, bad = self.good, self.bad

        def measure(batches):
            sizes = Compressors(good, bad)
            for batch in batches:
                found = [sizes.difference(x.as_py() or "") for x in batch.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(found, pa.float64())], [key, "difference"]
                )

        return frame.select(key, "text").mapInArrow(measure, f"{key} {kind}, difference double")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE) -> Model:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    One half gives the dictionaries: every document a piece of the same length, as long as all of
    them fit into DICTIONARY, taken at a place that the text's hash chooses. The other half, whole,
    gives the rising curve that turns differences into scores. Only the pieces and one number per
    document reach the driver. Without text of both classes every score is the share of good
    documents among those sampled, or one half.
    """
    chosen = labelled.sample(docs, labels, label, rows)
    halves = F.col("turn") % 2 == 0
    given = chosen.where(halves & (F.length("text") > 0))
    sizes = {r["label"]: r["n"] for r in given.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pieces = []
    for kind, n in sizes.items():
        size = max(1, DICTIONARY // n)
        room = F.greatest(F.length("text") - size, F.lit(0)) + 1
        place = F.pmod(F.xxhash64("text"), room).cast("int") + 1
        piece = F.substring("text", place, F.lit(size)).alias("piece")
        pieces += given.where(F.col("label") == kind).select("label", "turn", piece).orderBy("turn", "piece").collect()
    texts = [
        b"".join(r["piece"].encode("utf-8", "surrogatepass") for r in pieces if r["label"] == kind)
        for kind in (1, 0)
    ]
    if min(map(len, texts)) < 8:
        model, known = Model(b" " * 8, b" " * 8), chosen.select("label").collect()
        values, y = np.zeros(len(known)), np.array([r["label"] for r in known], float)
    else:
        model = Model(*texts)
        found = model.differences(chosen.where(~halves), "label", "int").collect()
        values = np.array([r["difference"] for r in found])
        y = np.array([r["label"] for r in found], float)
    model.calibrate(values, y)
    return model


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Whole texts are compressed, in chunks. A null or empty text saves nothing and gets the
    curve's value there. Repeated rows are scored each, alike. Needs doc_id and text.
    """

    def scored(batches):
        sizes = Compressors(model.good, model.bad)
        for batch in batches:
            found = [sizes.difference(x.as_py() or "") for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.scores(found))], ["doc_id", "score"]
            )

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scored, SCORED
    )
    return found.select(
        "doc_id",
        labelled.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= keep).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs``, whole, that are not rejected."""

    def choose(batches):
        sizes = Compressors(model.good, model.bad)
        for batch in batches:
            found = [sizes.difference(x.as_py() or "") for x in batch.column("text")]
            yield batch.filter(pa.array(model.scores(found) >= keep))

    return docs.mapInArrow(choose, docs.schema)
