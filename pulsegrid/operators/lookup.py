"""Joins against a side whose size decides the strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
SALT_BUCKETS = 64
#: A key with this share of all facts or more is spread; so many keys there can be at most.
HOT_SHARE = 1 / 256
#: Keys a task's sketch tells apart. Its counts are off by less than a thousandth of all facts.
SKETCH_ITEMS = 10_000


def measured_bytes(df: DataFrame, row_bytes: str | int) -> float:
    """Estimated size of ``df``: one aggregate over it, of which a single row reaches the driver.

    ``row_bytes`` is a number or an SQL expression per row.
    """
    return df.agg(F.sum(F.expr(f"CAST({row_bytes} AS DOUBLE)"))).first()[0] or 0.0


def hot_keys(
    facts: DataFrame, key: str, share: float = HOT_SHARE, items: int = SKETCH_ITEMS
) -> list:
    """Keys with about ``share`` of the facts or more, at most ``1 / share`` of them.

    One pass over the key alone, into frequent-item sketches that merge; their size is fixed by
    ``items``. Facts without a key are not among them.
    """
    most = int(1 / share)
    keyed = facts.where(F.col(key).isNotNull())
    row = keyed.agg(
        F.count("*").alias("facts"),
        F.expr(f"approx_top_k({key}, {most}, {items})").alias("top"),
    ).first()
    return [t["item"] for t in row["top"] or [] if t["count"] >= share * row["facts"]]


def salted_sides(
    facts: DataFrame, side: DataFrame, key: str, hot: list, spread_by: str, salt_buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt``: hot keys have ``salt_buckets`` of them, all others one.

    A fact's salt comes from its own content, so a retried task produces the same rows. Facts
    without a key find nothing and are spread as well.
    """
    hashed = F.expr(f"pmod(xxhash64({spread_by}), {salt_buckets}L)")
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    spread = F.when(is_hot | F.col(key).isNull(), hashed).otherwise(F.lit(0).cast("long"))
    last = F.when(is_hot, F.lit(salt_buckets - 1)).otherwise(F.lit(0)).cast("long")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), last))
    return facts.withColumn("_salt", spread), side.withColumn("_salt", copies)


def lookup_left(
    facts: DataFrame,
    side: DataFrame,
    key: str,
    side_bytes: float,
    spread_by: str,
    limit: int = BROADCAST_LIMIT_BYTES,
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Left join of a large, possibly skewed fact side to at most one ``side`` row per key.

    Up to ``limit`` bytes the side is broadcast and the facts do not move. Beyond it both sides
    are shuffled by (key, salt). Only keys that hold a notable share of the facts have more than
    one salt (:func:`hot_keys`), so the side is not multiplied, and a key with a third of all
    facts is spread over ``salt_buckets`` partitions. Of a stream the shares are not known, so
    there all keys have all salts.
    """
    if side_bytes <= limit:
        return facts.join(F.broadcast(side), key, "left")
    if facts.isStreaming:
        salted = facts.selectExpr("*", f"pmod(xxhash64({spread_by}), {salt_buckets}L) AS _salt")
        copies = side.selectExpr("*", f"explode(sequence(0L, {salt_buckets - 1}L)) AS _salt")
    else:
        hot = hot_keys(facts, key)
        salted, copies = salted_sides(facts, side, key, hot, spread_by, salt_buckets)
    return salted.join(copies.hint("shuffle_merge"), [key, "_salt"], "left").drop("_salt")
