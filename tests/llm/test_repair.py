"""Conversation repair against all edits of short conversations, and against the SQL of the query."""

import itertools
import random
import re
import zlib

import duckdb
import pytest

from pulsegrid.llm import repair
from pulsegrid.llm.queries import SQL

SHAPE = "conv_id long, turn long, role string, text string, known string, h int"
FORM = re.compile(r"(s?(ua)+)?")
ROLES = ["system", "user", "assistant", "tool", None]
TEXTS = ["Well. ", "No", "Yes!", "", " \n", "Why?", None]


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], SHAPE)


def by_sql(rows):
    """Rows of the query's SQL over (conv_id, turn, role, text)."""
    import pandas as pd

    connection = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    frame = frame.astype({"conv_id": "Int64", "turn": "Int64", "role": "string", "text": "string"})
    connection.register("conversations", frame)
    return connection.sql(SQL["op13_repair"]).fetchall()


def ours(frame, **parameters):
    return [tuple(r) for r in repair.audit(frame, **parameters).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def all_edits(rows):
    """Cheapest (cost, letters) over every way to edit a few (role, text) rows."""
    seen, choices = set(), []
    for role, text in rows:
        gone = not text.strip(" \t\n\x0b\x0c\r") or (role, text) in seen
        seen.add((role, text))
        cut = 5 * (text.rstrip()[-1:] not in (".", "!", "?"))
        choices.append([("D", 2, "")])
        if not gone:
            choices[-1] += [("K", cut, role[:1] or "?"), ("R", 1 + cut, "u"), ("R", 1 + cut, "a")]
    gaps = [("", ""), ("I", "u"), ("I", "a"), ("II", "ua"), ("II", "au")]
    best = None
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        if sum(len(i[0]) for i in inserts) > 3:
            continue
        for edits in itertools.product(*choices):
            made = "".join(i[1] + e[2] for i, e in zip(inserts, [*edits, ("", 0, "")], strict=True))
            if not FORM.fullmatch(made):
                continue
            letters = "".join(i[0] + e[0] for i, e in zip(inserts, [*edits, ("", 0, "")], strict=True))
            cost = sum(5 * len(i[0]) for i in inserts) + sum(e[1] for e in edits)
            best = min(best or (cost, letters), (cost, letters))
    return best


def test_short_conversations_get_the_cheapest_edits(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for conv in range(60):
        own = [(rng.choice(ROLES[:4]), rng.choice(TEXTS[:6])) for _ in range(rng.randint(1, 3))]
        rows += [(conv, turn, *r) for turn, r in enumerate(own)]
        want[conv] = all_edits(own)
    found = repair.Repair(repair.keyed(table(spark, rows)), chunk=1).conversations().collect()
    assert {r.conv: (r.cost, r.audit) for r in found} == want
    # deleting a row shifts what follows as inserting one does, for less
    assert {x for _, letters in want.values() for x in letters} == set("DKR")


def test_inserts_close_what_is_open():
    assert repair.closing(repair.AFTER_SYSTEM) == ("II", ["user", "assistant"])
    assert repair.closing(repair.AFTER_USER) == ("I", ["assistant"])
    assert repair.END == (0, 10, 5, 0)
    # behind an assistant row another can only stand with a user's row between
    letters, inserted, role, state = repair.forth(repair.ASSISTANT, (9, 9, 9, 0), repair.AFTER_ASSISTANT)
    assert (letters, inserted, role, state) == ("D", (), None, repair.AFTER_ASSISTANT)


def odd_conversations():
    rng = random.Random(8)
    rows = []
    for conv in (None, -3, *range(30)):
        for turn in range(rng.choice([1, 2, 5, 12])):
            text = rng.choice(TEXTS) if rng.random() < 0.3 else f"Text {rng.randrange(10**6)}."
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(ROLES), text))
    rows = list({(r[0], r[1]): r for r in rows}.values())  # one row a turn
    rows += [(40, None, "user", "Two rows without a turn."), (41, 2, "user", "x" * 300_000 + ".")]
    rows += [(42, 1, "user", "Said again and again.")] * 9  # one row, many times
    dropped = next(k for k in range(10**4) if zlib.crc32(f"43:{k}".encode()) % 20 == 0)
    return [*rows, (43, dropped, "user", "All of it is dropped.")]


@pytest.mark.parametrize("chunk", [2, repair.CHUNK])
def test_odd_rows_agree_with_sql(spark, chunk):
    rows = odd_conversations()
    found = ours(table(spark, rows), chunk=chunk)
    want = by_sql(rows)
    assert order(found) == order(want)
    last = next(r for r in found if r[0] == 43)
    assert last[1:8] == (0, 0, 0, 0, 0, 0, "")


def test_one_long_conversation_is_split_over_chunks(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"Part {t}.") for t in range(400)]
    rows += [(8, 0, "user", "Short."), (8, 1, "assistant", "Yes.")]
    found = ours(table(spark, rows), chunk=8)
    assert order(found) == order(by_sql(rows))


def test_turns_shared_by_different_rows_have_one_order(spark):
    rows = [(1, 3, role, text) for role in ("user", "assistant") for text in ("A.", "B.", "C.")]
    first = ours(table(spark, rows))
    assert first == ours(table(spark, rows[::-1]), chunk=2)
    assert first[0][0] == 1


def test_speculation_is_wrong_at_first_and_mended(spark):
    # every row is kept or given a role, so what stands behind decides up to the first one
    rows = repair.keyed(table(spark, [(1, t, "user", f"T {t}.") for t in range(64)]))
    repaired = repair.Repair(rows, chunk=2)
    codes = [repair.USER] * 64
    want, _ = repair.backward(codes, repair.END)
    got = {r.first_place: tuple(r.left) for r in repaired.chunks.collect()}
    assert [got[k] for k in sorted(got)] == want[:-1:2]


def test_an_empty_table_gives_no_rows(spark):
    assert ours(table(spark, [])) == []
