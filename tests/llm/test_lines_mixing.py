import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import lines, mixing
from tests.llm.conftest import ODD


def test_boilerplate_goes_but_copies_stay(documents):
    page = "\n".join(f"own words of page {{0}} line {k}" for k in range(4))
    docs = [(k, page.format(k) + "\n  accept all \t\r\n\nmenu", f"s{k}") for k in range(12)]
    docs += [(50 + k, "menu\naccept all", f"s{k}") for k in range(3)]
    docs += [(60, "menu\n" + page.format(0) + "\naccept all\nmenu", "s3"), (61, "rare line", "s1")]
    found = {r.row.doc_id: r for r in lines.remove_boilerplate(documents(*docs)).collect()}
    assert found[3].n_removed == 2 and found[3].kept == page.format(3) + "\n"
    assert found[60].n_removed == 3 and found[60].kept == page.format(0)
    assert found[50].n_removed == 0 and found[50].kept == "menu\naccept all"  # nothing but such lines
    assert found[61].kept == "rare line" and found[3].row.key == "k"


@pytest.mark.parametrize("sites, goes", [(9, 0), (10, 1), (11, 1), (40, 1)])
def test_threshold_is_exact(documents, sites, goes):
    docs = [(k, "a line of its own, quite long %d\nshared" % k, f"s{k}") for k in range(sites)]
    docs += [(100 + k, "another text of some length %d\nshared" % k, "s0") for k in range(5)]
    rows = lines.remove_boilerplate(documents(*docs)).collect()
    assert {r.n_removed for r in rows} == {goes}


def test_documents_without_source_are_one_site(documents):
    docs = [(k, f"long enough to be kept {k}\nshared", None) for k in range(20)]
    assert {r.n_removed for r in lines.remove_boilerplate(documents(*docs)).collect()} == {0}


def test_odd_rows_of_lines(documents):
    rows = lines.remove_boilerplate(documents(*ODD), min_sites=2).collect()
    found = {r.row.doc_id: (r.n_lines, r.n_removed, r.kept) for r in rows}
    assert len(rows) == len(ODD)
    assert found[1] == (0, 0, None) and found[2] == (1, 0, "") and found[3] == (2, 0, " \t\n ")
    assert lines.remove_boilerplate(documents()).count() == 0


def test_spread_lines_are_broadcast_or_shuffled_alike(documents, monkeypatch):
    docs = [(k, f"everywhere\nown {k}\n{'twelfth' if k % 12 == 0 else 'x%d' % k}", f"s{k % 40}") for k in range(240)]
    plans, found = [], []
    for most in (lines.BROADCAST_LINES, 0):
        monkeypatch.setattr(lines, "BROADCAST_LINES", most)
        frame = lines.remove_boilerplate(documents(*docs))
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        found.append(sorted((r.row.doc_id, r.n_lines, r.n_removed, r.kept) for r in frame.collect()))
    assert found[0] == found[1] and {r[2] for r in found[0]} == {1, 2}
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]


def test_targets_fill_up_by_weight(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 50), (None, 10), ("z", 0)]
    frame = spark.createDataFrame(sizes, "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    targets, weights = {s: 0.0 for s, _ in sizes}, {"a": 5, "b": 2, "c": 1, "z": 5, None: 2}
    left, free = 1.5 * sum(n for _, n in sizes), set(targets)
    while left > 1e-9 and free:  # share, stop, share the excess again
        part = left / sum(weights[s] for s in free)
        left = 0.0
        for s in list(free):
            targets[s] += part * weights[s]
            if targets[s] >= 2 * dict(sizes)[s]:
                left += targets[s] - 2 * dict(sizes)[s]
                targets[s] = 2.0 * dict(sizes)[s]
                free.remove(s)
    assert found == pytest.approx(targets)


def test_mix_comes_near_its_targets(documents):
    docs = [(k, "w " * (1 + k % 13), f"s{k % 7}") for k in range(4000)]
    plan = mixing.plan_mix(documents(*docs))
    shares = plan.groupBy("row.source").agg(
        (F.sum(F.col("size") * F.col("copies")) / F.first("target")).alias("share")
    )
    assert all(abs(r.share - 1) < 0.08 for r in shares.collect())
    assert plan.where("copies > 2").count() == 0
    again = mixing.mix(documents(*docs)).groupBy("doc_id").count().collect()
    expected = {r.doc_id: r.copies for r in plan.select("row.doc_id", "copies").collect() if r.copies}
    assert {r.doc_id: r["count"] for r in again} == expected


def test_odd_rows_of_a_mix(documents, monkeypatch):
    for most in (mixing.BROADCAST_SOURCES, 0):  # both ways of joining
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", most)
        rows = mixing.plan_mix(documents(*ODD)).collect()
        assert len(rows) == len(ODD)
        assert {r.row.doc_id: r.size for r in rows} == {None: 5, 1: 0, 2: 0, 3: 0, 4: 1, 5: 3, 6: 50_000}
        assert mixing.plan_mix(documents()).count() == 0
    assert mixing.mix(documents(*ODD)).columns[-2:] == ["key", "h"]
