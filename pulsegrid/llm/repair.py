"""Repair damaged conversations with the fewest edits: Viterbi over chunks, in parallel.

A repaired conversation alternates user and assistant behind at most one system row and ends with
an assistant row. What matters of the rows before a place is one of four states, so a row turns a
vector of four costs into another one, by sums and minima. Chunks of rows therefore run from
speculative vectors at the same time, and are run again from what their neighbour found until no
vector changes by more than a constant; such vectors lead to the same choices.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import materialize

CHUNK = 4096  # rows that run one behind the other; a power of two
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
SYSTEM, USER, ASSISTANT, OTHER = range(4)
TRUNCATED, GONE = 4, 8  # flags beside a row's kind
DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: What is emitted next, by state; a system row can only come first.
NEXT_ROLE = (USER, USER, ASSISTANT, USER)
TO = {USER: AFTER_USER, ASSISTANT: AFTER_ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
SPECULATIVE = (0, 0, 0, 0)

CONV = ["conv", "known"]


# ---- one row, one chunk ------------------------------------------------------------------


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs from each state when rows may be inserted first; two in a row are enough."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[TO[NEXT_ROLE[s]]]) for s, c in enumerate(costs)]
    return tuple(costs)


END = _with_inserts([0, 99, 99, 0])


def _step(kind: int, state: int) -> int | None:
    """The state behind a row of that kind, or None where it may not stand."""
    if kind == SYSTEM:
        return AFTER_SYSTEM if state == START else None
    return TO[kind] if kind == NEXT_ROLE[state] else None


def _edits(code: int, state: int):
    """(letter, cost, next state) of what can become of a row, least letter first."""
    kind, cut = code & 3, CUT if code & TRUNCATED else 0
    yield "D", DELETE, state
    if code & GONE:
        return
    kept = _step(kind, state)
    if kept is not None:
        yield "K", cut, kept
    yield "R", cut + REROLE, TO[NEXT_ROLE[state]]


@lru_cache(maxsize=1 << 14)
def back(code: int, costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Least costs from each state before a row, less their minimum, and that minimum.

    Few vectors occur, since states differ by a few edits at most; so most rows are a lookup.
    """
    before = _with_inserts([min(c + costs[to] for _, c, to in _edits(code, s)) for s in range(4)])
    least = min(before)
    return tuple(c - least for c in before), least


@lru_cache(maxsize=1 << 14)
def forth(code: int, costs: tuple[int, ...], state: int) -> tuple[str, tuple[str, ...], str | None, int]:
    """Edits up to and with one row on the way with the least letters: letters, roles inserted
    before it, its new role if it gets one, and the state behind it. ``costs``: behind the row."""
    before, least = back(code, costs)
    letters, inserted = "", []
    while True:
        need = before[state] + least
        found = sorted(e for e in _edits(code, state) if e[1] + costs[e[2]] == need)
        role = NEXT_ROLE[state]
        into = need == INSERT + before[TO[role]] + least
        if found and (not into or found[0][0] < "I"):
            letter, _, to = found[0]
            return letters + letter, tuple(inserted), NAMES[role] if letter == "R" else None, to
        letters, state = letters + "I", TO[role]
        inserted.append(NAMES[role])


def backward(codes: list[int], costs: tuple[int, ...]) -> tuple[list[tuple[int, ...]], int]:
    """Vectors before each row and behind the last, each with minimum 0, and what was taken off."""
    vectors, taken = [costs], 0
    for code in reversed(codes):
        costs, least = back(code, costs)
        vectors.append(costs)
        taken += least
    return vectors[::-1], taken


def trace(codes: list[int], vectors: list[tuple[int, ...]], state: int) -> tuple[list[tuple], int]:
    """The edits of every row, and the state behind the last."""
    found = []
    for code, costs in zip(codes, vectors[1:], strict=True):
        found.append(forth(code, costs, state))
        state = found[-1][3]
    return found, state


def closing(state: int) -> tuple[str, list[str]]:
    """Inserts behind the last row: letters and roles."""
    roles = []
    while state in (AFTER_SYSTEM, AFTER_USER):
        roles.append(NAMES[NEXT_ROLE[state]])
        state = TO[NEXT_ROLE[state]]
    return "I" * len(roles), roles


# ---- rows --------------------------------------------------------------------------------


def keyed(rows: DataFrame) -> DataFrame:
    """conv and known (for conv_id, which may be null), turn, role and text; null role or text is
    one blank."""
    blank = F.lit(" ")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("conv_id").isNotNull().alias("known"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), blank).alias("role"),
        F.coalesce(F.col("text"), blank).alias("text"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """The rows of :func:`keyed`, damaged by a hash of conversation and turn: of 20 values 0 drops
    a row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it
    and 4 makes it the user's. A null id or turn is one blank in what is hashed."""
    name = F.concat(
        F.when(F.col("known"), F.col("conv").cast("string")).otherwise(" "),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    lot = F.crc32(name.cast("binary")) % 20
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", STOPS, ""))
    return (
        rows.withColumn("lot", lot)
        .where("lot <> 0")
        .withColumn("copy", F.explode(F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            *CONV,
            "turn",
            F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.otherwise(F.col("text")).alias("text"),
        )
    )


def _names(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")]


def coded(rows: DataFrame) -> DataFrame:
    """One short row per different (conversation, turn, role, text): how many copies it has, and
    its code. Texts are hashed here and do not travel."""
    solid = F.rtrim("text", F.lit(BLANKS))
    short = (
        rows.select(
            *CONV,
            "turn",
            "role",
            *_names(F.col("text")),
            (F.length(solid) == 0).alias("blank"),
            (~F.right(solid, F.lit(1)).isin(*STOPS)).alias("truncated"),
        )
        .groupBy(*CONV, "turn", "role", "h", "g")
        .agg(
            F.count("*").alias("copies"),
            F.first("blank").alias("blank"),
            F.first("truncated").alias("truncated"),
        )
    )
    short = materialize(short)
    same = [*CONV, "role", "h", "g"]
    # a null turn comes first
    seen = short.groupBy(*same).agg(
        F.min("turn").alias("first_turn"), F.bool_or(F.col("turn").isNull()).alias("first_null")
    )
    later = F.col("turn").isNotNull() & (F.col("first_null") | (F.col("turn") > F.col("first_turn")))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
    gone = F.col("blank") | F.col("again")
    cut = ~gone & F.col("truncated")
    return (
        short.join(seen, same)
        .withColumn("again", later)
        .select(
            *CONV,
            *("turn", "role", "h", "g", "copies"),
            F.when(F.col("blank"), F.col("copies")).otherwise(0).alias("blank"),
            F.when(F.col("blank"), 0).otherwise(F.col("copies") - F.when(F.col("again"), 0).otherwise(1)).alias("duplicate"),
            cut.cast("long").alias("truncated"),
            (kind.otherwise(OTHER) + F.when(gone, GONE).otherwise(0) + F.when(cut, TRUNCATED).otherwise(0)).alias("code"),
        )
    )


def placed(codes: DataFrame, chunk: int) -> DataFrame:
    """The rows of :func:`coded` with their place in a global order by conversation and turn, and
    the chunk it belongs to. A range partition holds consecutive rows, of one long conversation or
    of many short ones, so no conversation has to fit into a task."""
    order = [F.asc(c) for c in CONV] + [F.asc_nulls_first("turn"), F.asc("role"), F.asc("h"), F.asc("g")]
    return (
        codes.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("chunk", F.shiftright("place", chunk.bit_length() - 1))
    )


# ---- chunks ------------------------------------------------------------------------------


def _legal(a: Column, b: Column) -> Column:
    return ((b == USER) & ((a == SYSTEM) | (a == ASSISTANT))) | ((a == USER) & (b == ASSISTANT))


def _chunks(rows: DataFrame) -> DataFrame:
    """One row per conversation and chunk: its codes in order, the chunks before and after it, and
    how many neighbours of its rows, up to the first of the next chunk, are illegal."""
    from pyspark.sql import Window

    gathered = rows.groupBy(*CONV, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("place", "code"))).alias("rows"),
        (F.sum("copies") - F.count("*")).alias("copied"),  # neither legal nor kept
    )
    gathered = materialize(
        gathered.select(
            *CONV,
            *("chunk", "copied"),
            F.col("rows.place")[0].alias("first_place"),
            F.col("rows.code").alias("codes"),
        ).withColumn("kinds", F.transform("codes", lambda c: c.bitwiseAND(3)))
    )
    order = Window.partitionBy(*CONV).orderBy("chunk")
    links = gathered.select(*CONV, "chunk", F.col("kinds")[0].alias("kind")).select(
        *CONV,
        "chunk",
        F.lag("chunk").over(order).alias("previous"),
        F.lead("chunk").over(order).alias("following"),
        F.lead("kind").over(order).alias("next_kind"),
    )
    pairs = F.zip_with(
        F.slice("kinds", F.lit(1), F.size("kinds") - 1),
        F.slice("kinds", F.lit(2), F.size("kinds") - 1),
        lambda a, b: (~_legal(a, b)).cast("long"),
    )
    within = F.aggregate(pairs, F.lit(0).cast("long"), lambda n, x: n + x)
    across = F.col("next_kind").isNotNull() & ~_legal(F.element_at("kinds", -1), F.col("next_kind"))
    return (
        gathered.join(links, [*CONV, "chunk"])
        .withColumn("illegal", F.col("copied") + within + across.cast("long"))
        .withColumn("more", DELETE * F.col("copied"))
        .drop("kinds", "copied", "next_kind")
    )


def _mapped(frame: DataFrame, function, columns: list[str], found: list[tuple], drop: list[str]) -> DataFrame:
    """``frame`` without the columns ``drop``, with what ``function`` makes of some columns of each
    row: one value per (name, Spark type, Arrow type) in ``found``."""
    keep = [c for c in frame.columns if c not in drop]

    def rows(batches):
        for batch in batches:
            args = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            values = list(zip(*(function(*x) for x in args), strict=True)) or [()] * len(found)
            arrays = [pa.array(v, kind) for v, (_, _, kind) in zip(values, found, strict=True)]
            names = [name for name, _, _ in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], keep + names)

    kinds = dict(frame.dtypes)
    schema = [f"{c} {kinds[c]}" for c in keep] + [f"{name} {kind}" for name, kind, _ in found]
    return frame.mapInArrow(rows, ", ".join(schema))


def _run_back(chunks: DataFrame) -> DataFrame:
    """Chunks, without their codes, with the vector ``left`` that their ``right`` leads to."""

    def run(codes, right):
        vectors, taken = backward(codes, tuple(right))
        return list(vectors[0]), taken

    found = [("left", "array<int>", pa.list_(pa.int32())), ("taken", "long", pa.int64())]
    return _mapped(chunks, run, ["codes", "right"], found, ["codes"])


def _vector(costs: tuple[int, ...]) -> Column:
    return F.array(*(F.lit(c) for c in costs))


def stitched(chunks: DataFrame) -> DataFrame:
    """Chunks, without their codes, with ``right``: the costs behind them, less a constant.

    All chunks but the last of a conversation start from a speculative vector. Chunks whose
    follower found another one are run again from that, all at a time, until there are none: in
    practice once or twice, since a few rows make vectors parallel, and at most as often as a
    conversation has chunks. Conversations of one chunk are right from the start.
    """
    guess = F.when(F.col("following").isNull(), _vector(END)).otherwise(_vector(SPECULATIVE))
    done = materialize(_run_back(chunks.withColumn("right", guess)))
    many = F.col("previous").isNotNull() | F.col("following").isNotNull()
    alone, state = done.where(~many), done.where(many)
    while True:
        offers = state.select(*CONV, F.col("chunk").alias("following"), F.col("left").alias("offer"))
        offered = state.join(offers, [*CONV, "following"], "left").select(*state.columns, "offer")
        stale = F.coalesce(F.col("offer") != F.col("right"), F.lit(False))
        if offered.where(stale).isEmpty():
            return alone.unionByName(state)
        again = (
            offered.where(stale)
            .drop("right", "left", "taken")
            .withColumnRenamed("offer", "right")
            .join(chunks.select(*CONV, "chunk", "codes"), [*CONV, "chunk"])
        )
        state = materialize(offered.where(~stale).drop("offer").unionByName(_run_back(again)))


def _entries(chunks: DataFrame) -> DataFrame:
    """Conversation, chunk and the state it is entered in, for chunks behind others.

    A chunk leads from each state to one state. Such maps are put together over 1, 2, 4 and so on
    chunks, so the rounds are as many as a conversation's number of chunks has digits.
    """

    def exits(codes, right):
        vectors, _ = backward(codes, tuple(right))
        return ([trace(codes, vectors, s)[1] for s in range(4)],)

    found = [("exits", "array<int>", pa.list_(pa.int32()))]
    many = chunks.where("previous IS NOT NULL OR following IS NOT NULL")
    maps = _mapped(many.select(*CONV, "chunk", "following", "codes", "right"), exits, ["codes", "right"], found, ["codes", "right"])
    maps = materialize(maps)
    leads = maps.select(*CONV, F.col("following").alias("chunk"), F.col("exits").alias("leads"))
    identity = _vector((0, 1, 2, 3))
    steps = materialize(
        many.select(*CONV, "chunk", F.col("previous").alias("from"))
        .join(leads, [*CONV, "chunk"], "left")
        .withColumn("leads", F.coalesce("leads", identity))
    )
    while not steps.where("from IS NOT NULL").isEmpty():
        before = steps.select(
            *CONV, F.col("chunk").alias("from"), F.col("from").alias("further"), F.col("leads").alias("first")
        )
        both = F.transform(F.coalesce("first", identity), lambda s: F.get("leads", s))
        steps = materialize(
            steps.join(before, [*CONV, "from"], "left").select(
                *CONV, "chunk", F.col("further").alias("from"), both.alias("leads")
            )
        )
    return steps.select(*CONV, "chunk", F.col("leads")[START].alias("entry"))


def _traced(chunks: DataFrame) -> DataFrame:
    """Chunks with the edits of each of their rows and the inserts behind a conversation's last."""

    def run(codes, right, entry, following):
        vectors, _ = backward(codes, tuple(right))
        found, state = trace(codes, vectors, entry)
        letters, roles = closing(state) if following is None else ("", [])
        edits = [{"letters": x[0], "inserted": list(x[1]), "new_role": x[2]} for x in found]
        return edits, letters, roles

    edit = pa.struct([("letters", pa.string()), ("inserted", pa.list_(pa.string())), ("new_role", pa.string())])
    found = [
        ("edits", "array<struct<letters: string, inserted: array<string>, new_role: string>>", pa.list_(edit)),
        ("closing", "string", pa.string()),
        ("closing_roles", "array<string>", pa.list_(pa.string())),
    ]
    return _mapped(chunks, run, ["codes", "right", "entry", "following"], found, ["codes", "right", "entry"])


# ---- the operator ------------------------------------------------------------------------


class Repair:
    """Repair of the rows of :func:`keyed` (damaged or not), as tables in the shared folder.

    Rows are taken by turn, null first; rows of one turn by role and a hash of the text. A row is
    blank, or repeats role and text of an earlier one, or is truncated if it does not end in a full
    stop, exclamation or question mark, in this order. Blank and repeated rows are deleted; others
    are kept, given another role or deleted, and rows may be inserted, at the least total cost and
    then with the letters (D, I, K, R) that come first. Rows without conv_id are one conversation.

    Texts are hashed at once and travel again only in :meth:`rows`. Copies of a row are one row with
    a count before they are shuffled. Long conversations are split over tasks as chunks.
    """

    def __init__(self, rows: DataFrame, chunk: int = CHUNK):
        if chunk & (chunk - 1):
            raise ValueError("chunk must be a power of two")
        self.source = rows
        self.placed = materialize(placed(coded(rows), chunk))
        chunks = materialize(_chunks(self.placed))
        joined = chunks.select(*CONV, "chunk", "codes", "first_place").join(
            stitched(chunks), [*CONV, "chunk", "first_place"]
        )
        entries = _entries(joined)
        known = joined.join(entries, [*CONV, "chunk"], "left").withColumn("entry", F.coalesce("entry", F.lit(START)))
        self.chunks = materialize(_traced(known))
        edits = self.chunks.select("first_place", F.posexplode("edits").alias("k", "edit"))
        self.edits = materialize(
            edits.select((F.col("first_place") + F.col("k")).alias("place"), "edit.*").join(self.placed, "place")
        )

    def conversations(self) -> DataFrame:
        """One row per conversation that has rows: faults, cost and the letters of all edits."""
        counts = self.placed.groupBy(*CONV).agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
            *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        )
        letters = F.concat("letters", F.expr("repeat('D', CAST(copies - 1 AS INT))"))
        parts = self.edits.groupBy(*CONV, "chunk").agg(
            F.array_join(F.array_sort(F.collect_list(F.struct("place", letters.alias("x"))))["x"], "").alias("part")
        )
        first = F.when(F.col("previous").isNull(), F.col("left")[START]).otherwise(0)
        sums = (
            self.chunks.join(parts, [*CONV, "chunk"])
            .groupBy(*CONV)
            .agg(
                F.sum("illegal").alias("illegal"),
                (F.sum(F.col("taken") + first) + F.sum("more")).alias("cost"),
                F.array_join(
                    F.array_sort(F.collect_list(F.struct("chunk", F.concat("part", "closing").alias("x"))))["x"], ""
                ).alias("audit"),
            )
        )
        return counts.join(sums, CONV)

    def rows(self) -> DataFrame:
        """The repaired rows: conv, known, place and k (their order), role, text. Inserted rows
        have an empty text."""
        same = [*CONV, "turn", "role", "h", "g"]
        texts = self.source.select(*CONV, "turn", "role", *_names(F.col("text")), "text").dropDuplicates(same)
        kept = self.edits.where(~F.col("letters").endswith("D")).alias("e")
        match = [F.col(f"e.{c}").eqNullSafe(F.col(f"t.{c}")) for c in same]
        own = kept.join(texts.alias("t"), match).select(
            *(f"e.{c}" for c in (*CONV, "place")),
            F.lit(1 << 20).alias("k"),
            F.coalesce("e.new_role", "e.role").alias("role"),
            "t.text",
        )

        def made(frame: DataFrame, place: Column, roles: str, first: int) -> DataFrame:
            return frame.select(*CONV, place.alias("place"), F.posexplode(roles).alias("k", "role")).select(
                *CONV, "place", (F.col("k") + first).alias("k"), "role", F.lit("").alias("text")
            )

        before = made(self.edits, F.col("place"), "inserted", 0)
        behind = made(self.chunks, F.col("first_place") + F.size("edits") - 1, "closing_roles", 1 << 21)
        return own.unionByName(before).unionByName(behind)


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text``, joined by line feeds, for :meth:`Repair.rows`.

    The hash needs a conversation's rows one behind the other. They stream through a task in order,
    so a long conversation takes time there and no memory.
    """
    import hashlib

    def run(batches):
        now, hashed = None, None
        for batch in batches:
            found = []
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            lines = batch.column(2).cast(pa.binary())
            for name, line in zip(names, lines, strict=True):
                if name != now:
                    if hashed:
                        found.append((*now, hashed.hexdigest()))
                    now, hashed = name, hashlib.sha256()
                else:
                    hashed.update(b"\n")
                hashed.update(line.as_buffer())
            if found:
                yield _digest_batch(found)
        if hashed:
            yield _digest_batch([(*now, hashed.hexdigest())])

    order = [*CONV, "place", "k"]
    line = F.concat_ws(":", "role", "text").alias("line")
    return (
        rows.repartition(*CONV)
        .sortWithinPartitions(*order)
        .select(*CONV, line)
        .mapInArrow(run, "conv long, known boolean, repaired_sha256 string")
    )


def _digest_batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.string()]
    arrays = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [*CONV, "repaired_sha256"])


def audit(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Damage ``conversations``, repair them, and report on every original conv_id.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A
    conversation all of whose rows were dropped has zeros, an empty audit and the hash of nothing;
    so has an empty table no rows. Needs conv_id, turn, role and text; nulls are told in
    :func:`keyed` and :func:`damage`, other columns may bear any name.
    """
    rows = keyed(conversations)
    repaired = Repair(damage(rows), chunk)
    found = repaired.conversations().join(digests(repaired.rows()), CONV, "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        rows.select(*CONV)
        .distinct()
        .join(found, CONV, "left")
        .select(
            F.when(F.col("known"), F.col("conv")).alias("conv_id"),
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
        )
    )
