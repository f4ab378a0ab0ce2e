"""Document fingerprints: a randomised edit embedding, sampled, banded and verified."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import mixed
from pulsegrid.session import materialize

SAMPLES = 256  # a fingerprint holds between half of and about all of that many symbols
PERIOD = 1024  # the walk's rules repeat after so many steps
AT_ONCE = 8 << 20  # characters walked over together
FEW = 24  # so few texts left are walked one by one
BANDS, BAND_SYMBOLS = 10, 6
LIKE = 0.8
BLOCK = 1024  # members of a band compared at a time
TEXT_PER_TASK = 64 << 20
#: One printable character per symbol; symbol 0 is the end of a text and is never written.
SYMBOLS = np.frombuffer(
    b"?abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_", np.uint8
)

PRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


# ---- the embedding -----------------------------------------------------------------------


def _levels(n: int) -> np.ndarray:
    """Level of each of the first n steps: half of them 0, a quarter 1, and so on. A text is
    sampled at the steps of its level and above, so that samples nest."""
    h = mixed(np.arange(n, dtype=np.uint64) + np.uint64(0x5BF03635))
    low = h & (~h + np.uint64(1))
    return np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64)


def level_of(n_chars: int) -> int:
    """The walk over n characters takes about 2n steps; so many halvings leave SAMPLES of them."""
    return max(0, math.ceil(math.log2(max(1, 2 * n_chars) / SAMPLES)))


class Walk:
    """Shared random walks: at step j on character c the walk stays or moves on, as a coin for
    (j mod PERIOD, c) says, and writes down what it stands on. Equal stretches of two texts are
    walked alike once the walks are in step, so few edits change few symbols."""

    def __init__(self):
        grid = np.arange(PERIOD * 256, dtype=np.uint64).reshape(PERIOD, 256)
        self.moves = (mixed(grid + np.uint64(77)) & np.uint64(1)).astype(np.int64)
        self.moves[:, 0] = 0  # class 0 is the end: the walk stays there
        self.rows = [bytes(row.astype(np.uint8)) for row in self.moves]
        self.levels = _levels(1 << 16)
        self.picked: dict[int, np.ndarray] = {}

    def levels_upto(self, n: int) -> np.ndarray:
        if len(self.levels) < n:
            self.levels = _levels(2 * n)
        return self.levels[:n]

    def __call__(self, texts: list[str]) -> list[tuple[int, bytes]]:
        """(level, symbols) of each text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        n = len(texts)
        base = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        codes = np.zeros(int(sizes.sum()) + n, np.uint8)
        marks = np.zeros(len(codes), np.uint8)
        for at, k in zip(base, order, strict=True):
            points = np.frombuffer(texts[k].encode("utf-32-le", "surrogatepass"), np.uint32)
            if not len(points):
                continue
            points = points.astype(np.uint64) + np.uint64(1)
            codes[at : at + len(points)] = 1 + mixed(points) % np.uint64(255)
            # a symbol stands for a character and the two before it
            near = points * np.uint64(0x1F123BB5)
            near[1:] += points[:-1] * np.uint64(0x9E3779B1)
            near[2:] += points[:-2] * np.uint64(0x85EBCA77)
            marks[at : at + len(points)] = 1 + mixed(near) % np.uint64(63)
        level = np.array([level_of(int(x)) for x in sizes], np.int64)
        limit = int(4 * sizes[0] + 64) if n else 0
        steps = self.levels_upto(limit)
        ends, at = base + sizes, base.copy()
        # for each level the first text that is sampled at it (levels fall along the order)
        first = np.searchsorted(-level, -np.arange(int(level.max(initial=0)) + 1), side="left")
        events: list[tuple[int, int, np.ndarray]] = []
        active, j = n, 0
        while active > FEW and j < limit:
            top = min(int(steps[j]), len(first) - 1)
            if first[top] < active:
                events.append((j, int(first[top]), marks[at[first[top] : active]]))
            at[:active] += self.moves[j % PERIOD][codes[at[:active]]]
            j += 1
            if j % 64 == 0:
                walking = np.flatnonzero(at[:active] < ends[:active])
                active = int(walking[-1]) + 1 if len(walking) else 0
        symbols: list[list[bytes]] = [[] for _ in range(n)]
        for k, own in enumerate(self._columns(events, level)):
            symbols[k].append(own)
        flat, marked = codes.tobytes(), marks.tobytes()
        for k in range(active):
            symbols[k].append(self._alone(flat, marked, int(at[k]), int(ends[k]), j, steps, int(level[k])))
        result: list = [None] * n
        for k in range(n):
            result[order[k]] = (int(level[k]), b"".join(symbols[k]).rstrip(b"\0"))
        return result

    def _columns(self, events, level: np.ndarray):
        """What the common steps wrote for each text."""
        for value in sorted(set(level.tolist()), reverse=True):
            own = np.flatnonzero(level == value)
            low, high = int(own[0]), int(own[-1]) + 1
            used = [(s, x) for _, s, x in events if s <= low]
            grid = np.zeros((high - low, len(used)), np.uint8)
            for k, (s, x) in enumerate(used):
                part = x[low - s : high - s]
                grid[: len(part), k] = part
            yield from (row.tobytes() for row in grid)

    def _alone(self, codes, marks, at: int, end: int, j: int, steps: np.ndarray, level: int) -> bytes:
        out, rows, mask = bytearray(), self.rows, PERIOD - 1
        for stop in (np.flatnonzero(steps[j:] >= level) + j).tolist():
            while j < stop:
                at += rows[j & mask][codes[at]]
                j += 1
            if at >= end:
                break
            out.append(marks[at])
        return bytes(out)

    # -- comparing --------------------------------------------------------------------------

    def thinned(self, level: int, symbols: bytes, to: int) -> np.ndarray:
        """The samples of a higher level among those of a lower one."""
        found = np.frombuffer(symbols, np.uint8)
        if to > level:
            steps = self.levels_upto(max(1 << 16, 4 * (len(found) + 64) << level))
            own = steps[steps >= level][: len(found)]
            found = found[own >= to]
        return found

    def likeness(self, a: tuple[int, bytes], b: tuple[int, bytes]) -> float:
        """Share of equal symbols: 1 less the Hamming distance over the longer sample."""
        if a == b:
            return 1.0
        level = max(a[0], b[0])
        x, y = self.thinned(*a, level), self.thinned(*b, level)
        n, most = min(len(x), len(y)), max(len(x), len(y))
        return float((x[:n] == y[:n]).sum()) / most if most else 0.0

    def picks(self, n: int) -> np.ndarray:
        """Which of n symbols each band takes. Every place of a band has its own order of step
        numbers and takes the first of them below n, so that the choice spreads over all n and
        texts of other lengths choose alike."""
        if n not in self.picked:
            places = np.arange(BANDS * BAND_SYMBOLS, dtype=np.uint64)[:, None] << np.uint64(32)
            order = mixed(mixed(places + np.arange(n, dtype=np.uint64)) + np.uint64(991))
            self.picked[n] = order.argmin(axis=1).reshape(BANDS, BAND_SYMBOLS)
        return self.picked[n]

    def bands(self, print_: tuple[int, bytes]) -> list[int]:
        """Band keys at the text's own level and the next, so that texts on two sides of a level
        still meet. Each band is a seeded choice among all symbols sampled at the level: with
        likeness LIKE two texts share one of the BANDS of a level by 1 - (1 - LIKE ** BAND_SYMBOLS)
        ** BANDS, wherever they differ."""
        keys = []
        for level in (print_[0], print_[0] + 1):
            found = self.thinned(*print_, level).astype(np.uint64)
            if len(found):  # 6 bits a symbol, then the band's number and level
                shifts = np.arange(BAND_SYMBOLS, dtype=np.uint64) * np.uint64(6)
                words = (found[self.picks(len(found))] << shifts).sum(axis=1, dtype=np.uint64)
                words += (np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS * level)) << np.uint64(6 * BAND_SYMBOLS)
                keys.extend(mixed(words).view(np.int64).tolist())
            elif level == print_[0]:  # texts without symbols meet each other
                keys.append(0)
        return keys


def written(print_: tuple[int, bytes]) -> str:
    """A fingerprint as text: its level and its symbols."""
    return f"{print_[0]:02d}:" + SYMBOLS[np.frombuffer(print_[1], np.uint8)].tobytes().decode()


def parsed(text: str) -> tuple[int, bytes]:
    back = np.zeros(256, np.uint8)
    back[SYMBOLS] = np.arange(len(SYMBOLS))
    return int(text[:2]), back[np.frombuffer(text[3:].encode(), np.uint8)].tobytes()


# ---- neighbours in id order --------------------------------------------------------------


def _ranges(docs: DataFrame) -> DataFrame:
    """Rows of (doc_id, text) dealt into ranges of ids, each with a guest at its end: the first
    row of the range after it (after the last range, of the first one)."""
    spark = docs.sparkSession
    size, rows = docs.select(F.sum(F.octet_length("text")), F.count("*")).first()
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // TEXT_PER_TASK)
    wanted = max(1, min(wanted, rows))
    shares = [k / wanted for k in range(1, wanted)]
    cuts = docs.select(F.percentile_approx("doc_id", shares or [0.5], 10_000)).first()[0]
    splits = [-math.inf, *sorted({float(x) for x in cuts or []}), math.inf]
    splits = splits if len(splits) > 2 else [-math.inf, 0.0, math.inf]
    dealt = Bucketizer(
        splits=splits, inputCol="place", outputCol="range", handleInvalid="keep"
    ).transform(docs.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf))))
    dealt = dealt.select("doc_id", "text", F.col("range").cast("int").alias("range"))
    firsts = (
        dealt.groupBy("range")
        .agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first"))
        .orderBy("range")
        .collect()  # one row per range
    )
    ranges = [r["range"] for r in firsts]
    hosts = dict(zip([r["first"] for r in firsts], [ranges[-1], *ranges[:-1]], strict=True)) if ranges else {}
    guests = spark.createDataFrame(list(hosts.items()), "first long, host int")
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    other = F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))
    return (
        dealt.withColumn("first", F.coalesce("doc_id", F.lit(-(2**63))))
        .join(F.broadcast(guests), "first", "left")  # at most one row per range
        .withColumn("seat", F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, other))))
        .select("seat.range", "seat.guest", "doc_id", "text")
        .repartition(len(splits) - 1, "range")
        .sortWithinPartitions("range", "guest", "doc_id", "text")
    )


def _pairs(batches):
    """Runs of rows with the text after each, bounded in size."""
    held, size, last = [], 0, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))
        for place, guest, doc_id, text in zip(*columns, strict=True):
            text = text or ""
            if last and last[0] == place and not last[1]:
                held.append((last[2], last[3], text))
                size += len(last[3])
                if size > AT_ONCE:
                    yield held
                    held, size = [], 0
            last = place, guest, doc_id, text
    if held:
        yield held


def _print_texts(batches):
    walk = Walk()
    for rows in _pairs(batches):
        texts, edited = [], []
        for _, text, after in rows:
            quarter = len(text) // 4
            texts.append(text)
            edited.append(text[: len(text) - quarter] + after[:quarter])
        n = len(rows)
        # the text after a row mostly is the next row's, but not at the end of a range or a run
        apart = [k for k in range(n) if k + 1 == n or rows[k][2] is not rows[k + 1][1]]
        prints = walk(texts + edited + [rows[k][2] for k in apart])
        own, changed, following = prints[:n], prints[n : 2 * n], prints[1:n] + prints[:1]
        for k, found in zip(apart, prints[2 * n :], strict=True):
            following[k] = found
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "edited_sha256": [
                    hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited
                ],
                "fingerprint": [written(x) for x in own],
                "edited_fingerprint": [written(x) for x in changed],
                "near_edited": [walk.likeness(a, b) for a, b in zip(own, changed, strict=True)],
                "near_next": [walk.likeness(a, b) for a, b in zip(own, following, strict=True)],
            }
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near the next text's is.

    The edited text has its last quarter replaced by as many first characters (or all) of the
    next document in id order; after the last comes the first. Likeness is the share of equal
    symbols. Needs doc_id and text. A null text is empty; two empty texts have likeness 1, an
    empty and another 0. A null id comes first, rows with one id are ordered by text, so of
    repeated rows each is the next of the one before. An empty table gives no rows.
    Texts are shuffled once, in ranges of ids; nothing but one id per range meets the driver.
    """
    return _ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(
        _print_texts, PRINTS
    )


def _verify(threshold: float):
    def verify(batches):
        walk = Walk()
        for batch in batches:
            pairs = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            alike = [walk.likeness(parsed(x), parsed(y)) >= threshold for x, y in pairs]
            yield batch.select(["nid", "near"]).filter(pa.array(alike, pa.bool_()))

    return verify


def _banded(batches):
    """nid, band: the name of each fingerprint with each of its bands."""
    walk = Walk()
    for batch in batches:
        keys = [walk.bands(parsed(x)) for x in batch.column("fingerprint").to_pylist()]
        nids = np.repeat(batch.column("nid").to_numpy(), [len(x) for x in keys])
        flat = np.array([k for x in keys for k in x], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(nids), pa.array(flat)], ["nid", "band"])


class _Samples:
    """Symbols of some fingerprints as rows of matrices, at their own level and at the next."""

    def __init__(self, prints: list[tuple[int, bytes]]):
        walk = Walk()
        self.level = np.array([level for level, _ in prints], np.int64)
        self.at = []
        for up in (0, 1):
            found = [walk.thinned(*x, x[0] + up) for x in prints]
            sizes = np.array([len(x) for x in found], np.int64)
            rows = np.zeros((len(found), sizes.max(initial=0)), np.uint8)
            for k, x in enumerate(found):
                rows[k, : len(x)] = x
            self.at.append((rows, sizes))

    def likeness(self, one: int, others: np.ndarray) -> np.ndarray:
        """As Walk.likeness, of one with several; those of one band are at most a level apart."""
        out = np.zeros(len(others))
        for apart in (-1, 0, 1):
            k = np.flatnonzero(self.level[others] - self.level[one] == apart)
            if not len(k):
                continue
            (x, n), (y, m) = self.at[apart == 1], self.at[apart == -1]
            width = min(x.shape[1], y.shape[1])
            mine = x[one, :width]
            same = ((y[others[k], :width] == mine) & (mine != 0)).sum(axis=1)
            most = np.maximum(m[others[k]], n[one])
            out[k] = np.where(most > 0, same / np.maximum(most, 1), 0.0)
        return out


def _compare_blocks(threshold: float):
    """The smallest alike first id of one block for each seeker of the other."""

    def compare(group):
        import pandas as pd

        group = group.sort_values(["first", "nid"], ignore_index=True)
        samples = _Samples([parsed(x) for x in group["fingerprint"]])
        first, upto, nid = (group[c].to_numpy() for c in ("first", "upto", "nid"))
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        here = group["block"].to_numpy() == i
        open_ = np.flatnonzero(group["seeks"].to_numpy())
        found, near = [], []
        for k in range(len(group)):
            if not len(open_):
                break
            # what comes later has larger ids still
            open_ = open_[upto[open_] > first[k]]
            asked = open_ if i == j else open_[here[open_] != here[k]]
            alike = asked[samples.likeness(k, asked) >= threshold]
            found.append(nid[alike])
            near.append(np.full(len(alike), first[k]))
            open_ = np.setdiff1d(open_, alike, assume_unique=True)
        return pd.DataFrame({"nid": np.concatenate(found or [nid[:0]]), "near": np.concatenate(near or [first[:0]])})

    return compare


def _leftover(seats: DataFrame, sides: DataFrame, heads: DataFrame, starred: DataFrame, threshold: float) -> DataFrame:
    """nid, near: what the bands' members find among each other where their head is not alike, or
    a smaller id than they know may still be there. Compared in pairs of blocks, each seeker until
    it has met its smallest."""
    known = starred.groupBy("nid").agg(F.min("near").alias("known"))
    others = (
        seats.join(heads, "band")
        .where("nid <> head")
        .join(sides.select("nid", "first"), "nid")
        .join(known, "nid", "left")
        .withColumn("upto", F.least("first", "known"))
        .withColumn("seeks", F.col("upto") > F.col("head_first"))
    )
    sought = (
        others.groupBy("band")
        .agg(F.count("*").alias("size"), F.max(F.when(F.col("seeks"), F.col("upto"))).alias("most"), F.min("first").alias("least"))
        .where("size > 1 AND most > least")
        .select("band", "size", "most")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    return (
        others.join(sought, "band")
        .where("seeks OR first < most")
        .withColumn("block", F.pmod(F.xxhash64("nid"), blocks))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .join(sides.select("nid", "fingerprint"), "nid")
        .select(
            "band",
            F.least("block", "with").alias("i"),
            F.greatest("block", "with").alias("j"),
            *("block", "nid", "first", "upto", "seeks", "fingerprint"),
        )
        .groupBy("band", "i", "j")
        .applyInPandas(_compare_blocks(threshold), "nid long, near long")
    )


def earlier_alike(prints: DataFrame, threshold: float = LIKE) -> DataFrame:
    """nid, near: for each fingerprint, named by its hash, the smallest id of one that shares a
    band with it and is alike by ``threshold``. Only fingerprints with such an id are listed.

    Equal fingerprints are one node. Each band is first compared with its head, the smallest id in
    it; then whoever its head does not settle is compared with the other members, so no alike
    pair of a band is missed, whatever the head is.
    """
    named = prints.where("doc_id IS NOT NULL").select(
        "doc_id", "fingerprint", F.xxhash64("fingerprint").alias("nid")
    )
    equal = (
        named.groupBy("nid")
        .agg(F.min("doc_id").alias("near"), F.count("*").alias("n"))
        .where("n > 1")
        .select("nid", "near")
    )
    banded = named.select("nid", "fingerprint").mapInArrow(_banded, "nid long, band long")
    shared = (
        banded.groupBy("band")
        .agg(F.min("nid").alias("x"), F.max("nid").alias("y"))
        .where("x <> y")
        .select("band")
    )
    met = materialize(banded.join(shared, "band", "left_semi").distinct())
    # of bands with the same members one is enough
    chosen = (
        met.groupBy("band")
        .agg(
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("nid")).alias("x"),
            F.bit_xor(F.xxhash64("nid", F.lit(1))).alias("y"),
        )
        .groupBy("size", "x", "y")
        .agg(F.min("band").alias("band"))
        .select("band")
    )
    seats = materialize(met.join(chosen, "band", "left_semi"))
    sides = materialize(
        named.join(seats.select("nid").distinct(), "nid", "left_semi")
        .groupBy("nid", "fingerprint")
        .agg(F.min("doc_id").alias("first"))
    )
    heads = materialize(
        seats.join(sides.select("nid", "first"), "nid")
        .groupBy("band")
        .agg(F.min(F.struct("first", "nid")).alias("head"))
        .select("band", F.col("head.nid").alias("head"), F.col("head.first").alias("head_first"))
    )
    pairs = seats.join(heads, "band").where("nid <> head").select("nid", "head").distinct()
    own = sides.select("nid", F.col("fingerprint").alias("x"))
    theirs = sides.select(F.col("nid").alias("head"), F.col("first").alias("near"), F.col("fingerprint").alias("y"))
    starred = materialize(
        pairs.join(own, "nid")
        .join(theirs, "head")
        .select("nid", "near", "x", "y")
        .mapInArrow(_verify(threshold), "nid long, near long")
    )
    rest = _leftover(seats, sides, heads, starred, threshold)
    return equal.unionByName(starred).unionByName(rest).groupBy("nid").agg(F.min("near").alias("near"))


def with_earlier(docs: DataFrame, threshold: float = LIKE) -> DataFrame:
    """Fingerprints, and ``near_id``: the smallest alike document found by bands, or its own id."""
    prints = materialize(fingerprints(docs))
    return (
        prints.withColumn("nid", F.xxhash64("fingerprint"))
        .join(earlier_alike(prints, threshold), "nid", "left")
        .withColumn("near_id", F.when(F.col("doc_id").isNotNull(), F.least("near", "doc_id")))
        .drop("nid", "near")
    )
