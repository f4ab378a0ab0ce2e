"""Each stage of the pipeline against a plain version, on its own input; the queries' SQL."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from checks import compare
from pulsegrid.llm import jaccard, lines, mixing
from pulsegrid.llm.queries import QUERIES, SQL
from pulsegrid.session import materialize
from tests.llm import brute
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, docs, FOLDER))
        seen[name] = docs, out
        docs = out
    return seen


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == list(stages) and len(stages) == 5
    for docs, _ in stages.values():
        assert docs.columns == pipeline.COLUMNS


def test_rejected_documents_go_unchanged_stay(stages):
    before, after = map(rows, stages["quality classifier"])
    assert set(after) < set(before) and all(before[k] == r for k, r in after.items())


def test_lines_go_documents_stay(stages):
    before, after = map(rows, stages["line dedup"])
    assert set(before) == set(after)
    sites = {}
    for r in before.values():
        for line in r.text.split("\n"):
            sites.setdefault(line.strip(" \t\r"), set()).add(r.source)
    spread = {x for x, s in sites.items() if x and len(s) >= lines.MIN_SITES}
    for k, r in before.items():
        parts = r.text.split("\n")
        whole = not {x.strip(" \t\r") for x in parts} - spread - {""}
        kept = "\n".join(x for x in parts if whole or x.strip(" \t\r") not in spread)
        assert (after[k].text, after[k].n_chars) == (kept, len(kept))


def test_one_of_each_group_stays(stages):
    before, after = map(rows, stages["n-gram Jaccard join"])
    found = brute.components([(k, r.text) for k, r in before.items()], jaccard.SHINGLE, jaccard.PERCENT)
    assert set(after) == {k for k, (_, c) in found.items() if k == c}


def test_copies_follow_the_plan(stages):
    before, after = stages["mixing sources to target weights"]
    plan = {r.row.doc_id: r.copies for r in mixing.plan_mix(before).collect()}
    taken = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert taken == {k: n for k, n in plan.items() if n}


def test_packing_holds_every_copy(stages):
    before, after = stages["packing"]
    copies = {r.doc_id: r["count"] for r in before.groupBy("doc_id").count().collect()}
    held = {r.doc_id: r["sum(length)"] / r["any_value(doc_tokens)"] for r in after.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "any_value"}).collect()}
    assert held == copies


def test_run_is_the_stages(spark, stages):
    assert pipeline.run(spark, FOLDER).count() == stages["packing"][1].count()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name, monkeypatch):
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.SQL, name, SQL[name])
    assert compare.differences(name, spark, "/root/testdata/sf0.01") is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() >= 200


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


@pytest.fixture()
def odd_folder(spark, documents, tmp_path):
    body = " ".join(f"w{k}" for k in range(60))
    rows = [
        *ODD,
        (7, body, "s1"), (7, body, "s1"),  # one row, twice
        (8, "Its own words, " + " ".join(f"v{k}" for k in range(60)), "s2"),
        (8, body, "s2"),  # another row with this id, a copy of 7
        (None, body, "s2"), (None, "no id " + body.upper().replace("W", "z"), None),
        *((100 + k, f"shared line\nown line {k}", f"site{k}") for k in range(12)),
        *((200 + k, "shared line", f"site{k}") for k in range(12)),
    ]
    documents(*rows).drop("key", "h").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(100 + k, k % 2, 0) for k in range(12)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_stages_on_odd_rows(spark, odd_folder):
    folder, rows = odd_folder
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "")
    good = pipeline.keep_good(spark, docs, folder)
    assert good.columns == pipeline.COLUMNS and good.count() <= len(rows)
    cleaned = sorted(pipeline.clean_lines(spark, docs, folder).collect(), key=key)
    assert len(cleaned) == len(rows)
    texts = {r.doc_id: r.text for r in cleaned if r.doc_id is not None and r.doc_id >= 100}
    assert all(texts[100 + k] == f"own line {k}" and texts[200 + k] == "shared line" for k in range(12))
    stay = sorted(pipeline.thin_out(spark, docs, folder).collect(), key=key)
    ids = [r.doc_id for r in stay]
    assert ids.count(7) == 1 and ids.count(5) == 1  # repeated rows are one
    assert [r.text[:3] for r in stay if r.doc_id == 8] == ["Its"]  # only the copy goes
    assert ids.count(None) == 2  # the copy without an id goes, the other two stay
    assert {1, 2, 3} <= set(ids)  # without words
    assert ids.count(200) == 1 and not set(range(201, 212)) & set(ids)
    plan = {(r.row.doc_id, r.row.text): r.copies for r in mixing.plan_mix(docs).collect()}
    mixed = pipeline.mix_sources(spark, docs, folder)
    assert mixed.count() == sum(plan[r[0], r[1]] for r in rows)
    ends = pipeline.pack(spark, docs, folder).groupBy("doc_id").agg({"length": "sum"})
    assert {r.doc_id for r in ends.collect()} == {r[0] for r in rows}


def test_stages_on_an_empty_table(spark, odd_folder):
    folder, _ = odd_folder
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_coins_of_rows_without_an_id_differ(spark, documents):
    rows = [(None, f"words of row {k}", "a") for k in range(300)] + [(k, "one two", "b") for k in range(99)]
    plan = mixing.plan_mix(documents(*rows)).where("source_size = 1200").collect()
    taken, target = sum(r.size * r.copies for r in plan), plan[0].target
    assert len(plan) == 300 and abs(taken - target) < 0.15 * target


def test_a_document_of_mostly_shared_lines_loses_them(documents):
    shared = "\n".join(f"a long line that all the sites have, number {k}" for k in range(5))
    rows = [(k, f"{shared}\nown {k}\n", f"site{k}") for k in range(12)] + [(50, shared, "x"), (51, "\n \n", "x")]
    found = {r.row.doc_id: r for r in lines.remove_boilerplate(documents(*rows)).collect()}
    assert all(found[k].kept == f"own {k}\n" and found[k].n_removed == 5 for k in range(12))
    assert (found[50].kept, found[50].n_removed, found[51].kept) == (shared, 0, "\n \n")
