"""Link documents by n-gram Jaccard similarity: rarest shingles, parity sketches, exact check."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import LOWER, Words, chunks, lists, mixed, runs
from pulsegrid.session import discard, materialize

SHINGLE, PERCENT = 5, 80
#: How common shingles are is counted in one of SHARE texts and kept for slots of hashes. It only
#: orders shingles: pairs are found whatever the order, a poor one makes more of them to check.
SHARE, SLOT_BITS = 8, 20
#: Bits of the short sketches that prune pairs before the exact check, and the set sizes from which
#: a text has the next one too: a sketch says nothing of sets much larger than half its bits.
FOLDED = (2048, 16384, 131072)
LARGER = (0, 2000, 16000)
SKETCH_ENDS = tuple(accumulate(bits // 64 for bits in FOLDED))  # words up to each of them
SMALL = 8  # buckets up to that size are paired by a join, larger ones in blocks
BLOCK = 1024
NO_ID = -(2**63)

NAMED = "row long, doc_id long, n_shingles long, sid long, sketch array<long>"
MET = "bucket long, n long, sid long"
SETS = "sid long, n long, shingles array<long>"


# ---- shingle sets ------------------------------------------------------------------------


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each text, and whose they are.

    A text with fewer than n words has its whole word sequence as its one shingle.
    """
    words = Words(LOWER[data], offsets)
    hashes, row = words.hashes(), words.text_of_word()
    starts = np.flatnonzero(words.whole(n))
    found, owner = [runs(hashes, n)[starts] if len(starts) else hashes[:0]], [row[starts]]
    for short in range(1, n):
        texts = np.flatnonzero(words.counts == short)
        at = words.first[texts]
        total = np.full(len(texts), short, np.uint64)
        for k in range(short):
            total = mixed(total + hashes[at + k])
        found.append(total)
        owner.append(texts)
    h, row = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def _set_ids(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit name per set, the same for equal sets."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mixed(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=total[1:])
    edges = np.searchsorted(row, np.arange(n + 1))
    sums = total[edges[1:]] - total[edges[:-1]]
    return mixed(sums ^ mixed(np.diff(edges).astype(np.uint64)))


# ---- prefixes and sketches ---------------------------------------------------------------


def _rarest(h, row, common: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles by which each of n texts is found, and whose they are.

    Two sets that reach the threshold share at least ``percent`` of either's shingles. So, whatever
    the order of all shingles, the first one they share is among the first that a set has before
    the rest is less than its ``percent``. Shingles are ordered by how ``common`` their slot is,
    then by hash: a passage of many texts comes last, and no pair is made for it alone.
    """
    order = np.lexsort((common[(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], row))
    h, row = h[order], row[order]
    first = np.searchsorted(row, np.arange(n + 1))
    sizes = np.diff(first)
    needed = (percent * sizes + 99) // 100
    used = np.arange(len(h)) - first[row] <= (sizes - needed)[row]
    return h[used], row[used]


def _short_sketches(h: np.ndarray, whose: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bits of each text's set as 64-bit words, shorter sketches first, and whose they are."""
    words, owner = [], []
    for bits, larger in zip(FOLDED, LARGER, strict=True):
        texts = np.flatnonzero(sizes >= larger)
        place = np.full(len(sizes), -1)
        place[texts] = np.arange(len(texts))
        used = place[whose] >= 0
        flat = np.zeros(len(texts) * bits, bool)
        at = place[whose[used]] * bits + (h[used] % np.uint64(bits)).astype(np.int64)
        np.logical_xor.at(flat, at, True)
        words.append(np.packbits(flat).view(np.int64))
        owner.append(np.repeat(texts, bits // 64))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(words)[order], owner[order]


def _name_texts(n: int):
    """Size, name and short sketch of every text's set."""

    def name(batches):
        for batch in batches:
            for row, data, offsets in chunks(batch.column("text")):
                size = len(offsets) - 1
                h, whose = _sets(data, offsets, n)
                sizes = np.bincount(whose, minlength=size)
                words, owner = _short_sketches(h, whose, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(row, size),
                        batch.column("doc_id").slice(row, size),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(_set_ids(h, whose, size).view(np.int64), mask=sizes == 0),
                        lists(words, owner, size, pa.int64()),
                    ],
                    ["row", "doc_id", "n_shingles", "sid", "sketch"],
                )

    return name


def _new_sets(batches, n: int):
    """Shingles of the texts of each chunk, whose they are, and names of the texts' sets; copies
    within a task come once, so that a text that is everywhere costs its shingles once a task."""
    seen = set()
    for batch in batches:
        for _, data, offsets in chunks(batch.column("text")):
            h, whose = _sets(data, offsets, n)
            sizes = np.bincount(whose, minlength=len(offsets) - 1)
            ids = _set_ids(h, whose, len(sizes)).view(np.int64)
            new = np.zeros(len(sizes), bool)
            for k in np.flatnonzero(sizes).tolist():
                if ids[k] not in seen:
                    seen.add(int(ids[k]))
                    new[k] = True
            used = new[whose]
            yield h[used], whose[used], ids


def _shingle_texts(n: int):
    """All shingles of every set."""

    def shingles(batches):
        for h, _, _ in _new_sets(batches, n):
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["shingle"])

    return shingles


def _prefix_texts(n: int, percent: int, common: np.ndarray):
    """The shingles by which a set is found, as buckets, with size and name of the set."""

    def prefix(batches):
        for h, whose, ids in _new_sets(batches, n):
            sizes = np.bincount(whose, minlength=len(ids))
            keys, owner = _rarest(h, whose, common, len(ids), percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(sizes[owner]), pa.array(ids[owner])],
                ["bucket", "n", "sid"],
            )

    return prefix


def _shared_buckets(percent: int):
    """Of rows sorted by bucket, n and sid, each once, those with another set of the bucket in
    reach of their size; a bucket may span batches."""

    def several(bucket, n, sid):
        new = np.ones(len(bucket), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (sid[1:] != sid[:-1])
        bucket, n, sid = bucket[new], n[new], sid[new]
        meet = (bucket[1:] == bucket[:-1]) & (100 * n[:-1] >= percent * n[1:])
        shared = np.concatenate([meet, [False]]) | np.concatenate([[False], meet])
        columns = [pa.array(x[shared]) for x in (bucket, n, sid)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "n", "sid"])

    def shared(batches):
        bucket = n = sid = np.zeros(0, np.int64)
        for batch in batches:
            bucket = np.concatenate([bucket, batch.column("bucket").to_numpy()])
            n = np.concatenate([n, batch.column("n").to_numpy()])
            sid = np.concatenate([sid, batch.column("sid").to_numpy()])
            if len(bucket) and bucket[0] != bucket[-1]:
                last = int(np.flatnonzero(bucket != bucket[-1])[-1]) + 1
                yield several(bucket[:last], n[:last], sid[:last])
                bucket, n, sid = bucket[last:], n[last:], sid[last:]
        if len(bucket):
            yield several(bucket, n, sid)

    return shared


def _set_texts(n: int):
    """The sets themselves, of the texts that were asked for."""

    def sets(batches):
        for batch in batches:
            wanted = batch.column("sid").to_numpy()
            for row, data, offsets in chunks(batch.column("text")):
                size = len(offsets) - 1
                h, whose = _sets(data, offsets, n)
                ids = _set_ids(h, whose, size).view(np.int64)
                found = pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        pa.array(np.bincount(whose, minlength=size).astype(np.int64)),
                        lists(h.view(np.int64), whose, size, pa.int64()),
                    ],
                    ["sid", "n", "shingles"],
                )
                yield found.filter(pa.array(ids == wanted[row : row + size]))

    return sets


# ---- pairs -------------------------------------------------------------------------------


def _pairs(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _in_reach(n, m, percent: int):
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _common(keyed: DataFrame, shingle: int) -> np.ndarray:
    """How common the most common shingle of each slot is, as a logarithm in 8 bits; 0 where no
    shingle of the texts looked at is in two of them."""
    slots = (
        keyed.where(F.pmod(F.xxhash64("text"), F.lit(SHARE)) == 0)
        .select("text")
        .mapInArrow(_shingle_texts(shingle), "shingle long")
        .groupBy("shingle")
        .agg(F.count("*").alias("texts"))
        .where("texts > 1")
        .groupBy(F.shiftrightunsigned("shingle", 64 - SLOT_BITS).alias("slot"))
        .agg(F.max("texts").alias("texts"))
        .toArrow()
    )
    common = np.zeros(1 << SLOT_BITS, np.uint8)
    texts = slots.column("texts").to_numpy()
    common[slots.column("slot").to_numpy()] = np.minimum(np.rint(8 * np.log2(texts)), 255)
    return common


def _both(pairs: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the size and a column of either set."""

    def side(name: str) -> DataFrame:
        return nodes.select(
            F.col("sid").alias(name), F.col("n").alias(f"n_{name}"), F.col(column).alias(f"x_{name}")
        )

    return pairs.join(side("a"), "a").join(side("b"), "b")


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose short sketches leave it open whether they reach the threshold; the longest
    that both have decides."""
    last = F.least(F.size("x_a"), F.size("x_b"))
    first = F.lit(1)
    for end in SKETCH_ENDS[:-1]:
        first = F.when(last > end, end + 1).otherwise(first)
    longest = [F.slice(x, first, last - first + 1) for x in ("x_a", "x_b")]
    apart = F.aggregate(
        F.zip_with(*longest, lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, x: total + x,
    )
    total = F.col("n_a") + F.col("n_b")
    fits = apart * (100 + percent) <= total * (100 - percent)
    return _both(pairs, nodes, "sketch").where(fits).select("a", "b")


def _verified(pairs: DataFrame, keyed: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The stored ``pairs`` that reach the threshold, stored. Sets are built for these alone, from
    one text of each."""
    asked = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    wanted = asked.join(nodes, "sid").select("sid", "row")
    texts = keyed.select("row", "text").join(wanted, "row").dropDuplicates(["row"])
    sets = materialize(texts.select("sid", "text").mapInArrow(_set_texts(shingle), SETS))
    common = F.size(F.array_intersect("x_a", "x_b"))
    total = F.col("n_a") + F.col("n_b")
    linked = _both(pairs, sets, "shingles").where(100 * common >= percent * (total - common))
    linked = materialize(linked.select("a", "b").distinct())
    discard(sets)
    return linked


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """Every member of a bucket with the bucket's hub: the member that meets most others, which
    in a group of near copies is the text they were made from."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    support = members.join(sizes, "bucket").groupBy("sid").agg(F.sum("size").alias("support"))
    hubs = (
        members.join(support, "sid")
        .groupBy("bucket")
        .agg(F.max_by(F.struct("sid", "n"), F.struct("support", "sid")).alias("hub"))
    )
    return (
        members.join(hubs, "bucket")
        .where((F.col("sid") != F.col("hub.sid")) & _in_reach("n", "hub.n", percent))
        .select(*_pairs(F.col("sid"), F.col("hub.sid")))
        .distinct()
    )


def _block_pairs(percent: int):
    """Pairs of two blocks of one bucket, of different components and near by their sketches."""

    def pair(group):
        import pandas as pd

        sketches = [np.asarray(x).view(np.uint64) for x in group["sketch"]]
        bits = np.array([x[: SKETCH_ENDS[0]] for x in sketches]).reshape(-1, SKETCH_ENDS[0])
        n, component = group["n"].to_numpy(), group["component"].to_numpy()
        sid, block = group["sid"].to_numpy(), group["block"].to_numpy()
        left = np.flatnonzero(block == group["i"].iloc[0])
        right = np.flatnonzero(block == group["j"].iloc[0])
        a, b = [], []

        def longest_fits(x: int, k: int) -> bool:
            last = min(len(sketches[x]), len(sketches[k]))
            first = max([0, *(end for end in SKETCH_ENDS if end < last)])
            apart = int(np.bitwise_count(sketches[x][first:last] ^ sketches[k][first:last]).sum(dtype=np.int64))
            return apart * (100 + percent) <= (n[x] + n[k]) * (100 - percent)

        for x in left:
            apart = np.bitwise_count(bits[right] ^ bits[x]).sum(axis=1, dtype=np.int64)
            fits = apart * (100 + percent) <= (n[right] + n[x]) * (100 - percent)
            fits &= component[right] != component[x]
            found = sid[[k for k in right[fits].tolist() if longest_fits(x, k)]]
            a.append(np.minimum(found, sid[x]))
            b.append(np.maximum(found, sid[x]))
        return pd.DataFrame({"a": np.concatenate(a or [sid[:0]]), "b": np.concatenate(b or [sid[:0]])})

    return pair


def _leftover(members: DataFrame, components: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a bucket but no component yet: by a join in buckets of at most SMALL
    members, in pairs of blocks beyond, where the sketches choose before a pair is made."""
    labelled = members.join(components, "sid", "left").withColumn(
        "component", F.coalesce("component", "sid")
    )
    mixed_buckets = (
        labelled.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x <> y")
        .select("bucket", "size")
    )
    labelled = labelled.join(mixed_buckets, "bucket")
    few = labelled.where(F.col("size") <= SMALL)
    one, other = few.alias("one"), few.alias("other")
    small = one.join(
        other,
        (F.col("one.bucket") == F.col("other.bucket"))
        & (F.col("one.sid") < F.col("other.sid"))
        & (F.col("one.component") != F.col("other.component"))
        & _in_reach("one.n", "other.n", percent),
    ).select(F.col("one.sid").alias("a"), F.col("other.sid").alias("b"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    large = (
        labelled.where(F.col("size") > SMALL)
        .withColumn("block", F.pmod(F.xxhash64("sid"), blocks))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .join(nodes.select("sid", "sketch"), "sid")
        .select(
            "bucket",
            F.least("block", "with").alias("i"),
            F.greatest("block", "with").alias("j"),
            *("sid", "component", "block", "n", "sketch"),
        )
        .groupBy("bucket", "i", "j")
        .applyInPandas(_block_pairs(percent), "a long, b long")
    )
    return small.unionByName(large).distinct()


# ---- components --------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """sid, component (the smallest sid reachable) of every node of the edges (a, b).

    Labels move along edges and then jump to their label's label; each round is written to the
    shared folder, so no round depends on an earlier one's executors. Nothing but the number of
    changes reaches the driver.
    """
    edges = materialize(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    )
    labels = materialize(
        edges.groupBy(F.col("a").alias("sid"))
        .agg(F.min("b").alias("near"))
        .select("sid", F.least("sid", "near").alias("component"))
    )
    while True:
        offered = (
            edges.join(labels.select(F.col("sid").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("sid"))
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(offered, "sid", "left").select(
            "sid", F.col("component").alias("was"), F.least("component", "near").alias("to")
        )
        jump = labels.select(F.col("sid").alias("to"), F.col("component").alias("further"))
        moved = materialize(
            nearer.join(jump, "to", "left").select(
                "sid", "was", F.least("to", "further").alias("component")
            )
        )
        labels = moved.select("sid", "component")
        if moved.where("was <> component").isEmpty():
            return labels


# ---- the operator ------------------------------------------------------------------------


def link(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """row, doc_id, n_shingles, component and component_id of every row of ``docs``.

    Words are lower-cased in A-Z; a document is the set of its distinct ``shingle``-word
    shingles, or its whole sequence if it is shorter. Two documents link if their Jaccard
    similarity is at least ``percent`` / 100; component_id is the smallest doc_id reachable.

    Needs doc_id and text. A document without words or text links with nothing. A null id counts
    as the smallest in the component and is reported as null; rows with one id are one document
    each. Equal sets are one node (named by 64 bits of hash, ``component`` is one of these names),
    so copies are never paired. ``row`` is a hash of id and text. Buckets are joined by their hub
    first; what does not join one component that way is compared pair by pair, so no link between
    different sets is missed.

    Texts are read again rather than kept: the rarest shingles go from the scan into one shuffle by
    bucket, of which only shared buckets are stored, and sets are built only for pairs whose short
    sketches are near.
    """
    keyed = docs.select(
        F.xxhash64("doc_id", "text").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )
    named = materialize(keyed.mapInArrow(_name_texts(shingle), NAMED))
    nodes = materialize(
        named.where("sid IS NOT NULL")
        .groupBy("sid")
        .agg(
            F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("key"),
            F.min("row").alias("row"),
            F.max("n_shingles").alias("n"),
            F.any_value("sketch").alias("sketch"),
        )
    )
    met = materialize(
        keyed.select("text")
        .mapInArrow(_prefix_texts(shingle, percent, _common(keyed, shingle)), MET)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "n", "sid")
        .mapInArrow(_shared_buckets(percent), MET)
    )
    # of buckets with the same members one is enough
    alike = met.groupBy("bucket").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("sid")).alias("x"),
        F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("y"),
    )
    chosen = alike.groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    members = materialize(met.join(chosen, "bucket"))
    discard(met)

    stars = materialize(_stars(members, percent))
    near = materialize(_near(stars, nodes, percent))
    edges = _verified(near, keyed, nodes, shingle, percent)
    rest = _leftover(members, components(edges), nodes, percent).join(stars, ["a", "b"], "left_anti")
    rest = materialize(_near(rest, nodes, percent))
    discard(members, stars, near)
    more = _verified(rest, keyed, nodes, shingle, percent)
    both = materialize(edges.unionByName(more))
    found = components(both)
    discard(edges, rest, more, both)

    grouped = nodes.join(found, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    smallest = grouped.groupBy("component").agg(F.min("key").alias("component_key"))
    names = grouped.join(smallest, "component").select("sid", "component", "component_key")
    component_id = F.coalesce("component_key", "doc_id", F.lit(NO_ID))
    return named.drop("sketch").join(names, "sid", "left").select(
        "row",
        "doc_id",
        "n_shingles",
        "component",
        F.when(component_id != NO_ID, component_id).alias("component_id"),
    )
