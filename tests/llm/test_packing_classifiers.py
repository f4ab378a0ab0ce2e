import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import labelled, packing, quality, toxicity
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.01"


def reference_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(reference_ids, "known"):
        reference_ids.known = Tokenizer.from_file(packing.default_tokenizer())
    return reference_ids.known.encode(text or "", add_special_tokens=False).ids + [2]


def check_pieces(rows, texts):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0
        assert r.length == 1 << r.bucket and len(r.ids) == 4 * r.length
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc_id, text in texts.items():
        own = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        ids = np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist()
        assert ids == reference_ids(text) and {r.doc_tokens for r in own} == {len(ids)}


def test_pieces_are_the_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check_pieces(packing.pieces(docs).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_odd_texts(documents, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    odd = ["a\x1cb é", "İstanbul ΣΑΣ ΑΣ foo,bar it's 12ab <|endoftext|>x ª!", "\x85a\xa0b Straße. ﬁn!! l'été, ÀÉ? ſ Źok", "éte É.", "ok! OK? ok", " \n", None]
    docs = [(k, t) for k, t in enumerate(odd)]
    check_pieces(packing.pieces(documents(*docs)).collect(), dict(docs))
    rows = packing.pieces(documents(*ODD)).collect()
    assert sum(r.doc_tokens for r in rows if r.doc_id == 5) == 2 * 4 * len([r for r in rows if r.doc_id == 5]) / 2
    assert packing.pieces(documents()).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(documents(), context=1000)


def test_buckets_are_written_apart(documents, spark, tmp_path):
    packing.write_buckets(packing.pieces(documents((1, "a b c d e"), (2, "a b c"))), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "bucket=2")).count() == 2


def test_fold_matches_its_definition(spark):
    rows = spark.range(200).select("id", labelled.held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_curves():
    x = np.linspace(-1, 1, 400)
    y = (x + np.sin(np.arange(400)) > 0).astype(float)
    slope, offset = labelled.calibrated(x, y)
    assert slope > 0 and abs(labelled.probability(x, slope, offset).mean() - y.mean()) < 0.01
    knots, shares = labelled.rising(x, y)
    assert (np.diff(knots) > 0).all() and (np.diff(shares) >= 0).all()
    assert abs(np.interp(x, knots, shares).mean() - y.mean()) < 0.02
    assert labelled.calibrated(np.zeros(0), np.zeros(0)) == (0.0, 0.0)
    assert labelled.rising(x, np.ones(400))[1][0] > 0.99


@pytest.fixture(scope="module")
def judged(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return docs, labels


def rates(scored, labels, label):
    rows = scored.where("held_out").join(labels, "doc_id").groupBy(label, "predicted").count().collect()
    n = {(r[label], r.predicted): r["count"] for r in rows}
    return tuple(n.get((k, k), 0) / max(1, n.get((k, 0), 0) + n.get((k, 1), 0)) for k in (0, 1))


def test_quality_of_unseen_documents(judged):
    docs, labels = judged
    bad, good = rates(quality.score(docs, quality.train(docs, labels)), labels, "quality")
    assert bad > 0.8 and good > 0.95


def test_toxicity_of_unseen_documents(judged):
    docs, labels = judged
    clean, toxic = rates(toxicity.score(docs, toxicity.fit(docs, labels)), labels, "toxic")
    assert clean > 0.97 and toxic > 0.7


def test_misspellings_share_subwords():
    calm = ["the quiet garden grows slowly", "rain falls on the old stones", "we read books at night"] * 30
    rude = [f"{t} you horrible nuisance" for t in calm]
    model = toxicity.train(calm + rude, [0] * 90 + [1] * 90)

    def value(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return model.scores(data, np.array([0, len(data)]))[0]

    assert value("the quiet garden horribble nuisanc3") > 0.5 > value("the quiet stones")


def test_classifiers_without_labels(documents, spark):
    docs = documents(*ODD)
    for rows in ([], [(4, 1, 1)], [(None, 0, 0), (4, 7, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        for scored in (
            quality.score(docs, quality.train(docs, labels)),
            toxicity.score(docs, toxicity.fit(docs, labels)),
        ):
            found = scored.collect()
            assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert quality.keep_good(docs, quality.train(docs, labels)).columns == docs.columns
    assert toxicity.score(documents(), toxicity.fit(docs, labels)).count() == 0
