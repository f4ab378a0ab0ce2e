"""Mix sources to target weights: repetition rates per source, whole copies plus a seeded coin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
SEED = "mix"
BROADCAST_SOURCES = 100_000  # rows of (source, two numbers): a few MB


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """source, source_size, target from rows of (source, size).

    Sources in code-point order, null last, get the weights in turn. They share ``share`` times
    all sizes; a target ends at ``limit`` times its source's size and the excess goes to the
    others by weight. The level at which that settles follows from the sources in the order in
    which they fill up, so no iteration is needed. Only one row per source comes together here.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, map(float, weights))), turn % len(weights))
    filled = Window.orderBy("fills_at", "turn").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()

    def rest(column: str) -> Column:
        before = F.coalesce(F.sum(column).over(filled), F.lit(0.0))
        return (share * F.sum("source_size").over(everything) if column == "cap" else
                F.sum(column).over(everything)) - before

    level = rest("cap") / rest("weight")
    return (
        per_source.withColumn("turn", turn)
        .withColumn("weight", weight)
        .withColumn("cap", limit * F.col("source_size"))
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
        .withColumn(
            "level", F.max(F.when(F.col("level") <= F.col("fills_at"), F.col("level"))).over(everything)
        )
        .select(
            "source",
            "source_size",
            F.least("cap", F.coalesce("level", "fills_at") * F.col("weight")).alias("target"),
        )
    )


def coin(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id, or on the text where there is none, and the seed."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("-"), F.md5(text)), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def plan_mix(
    docs: DataFrame, seed: str = SEED, carry: list[str] | None = None, **rules
) -> DataFrame:
    """Every row of ``docs`` in ``row`` (the columns ``carry``; whole by default), with size,
    source_size, target, rate and copies.

    Needs doc_id, text and source; other columns pass in ``row`` whatever their names. A null
    text has size 0, a null source is one source, rows with the same doc_id, or with none and the
    same text, share one coin. A source without words has rate 0. An empty table gives no rows.
    The targets are computed first and broadcast if they are at most BROADCAST_SOURCES rows, so
    that no text is shuffled; beyond, adaptive execution splits the hot source.
    """
    sizes = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry or docs.columns)).alias("row"),
        coin(F.col("doc_id"), F.col("text"), seed).alias("coin"),
        F.col("source").alias("source"),
        n_words(F.col("text")).alias("size"),
    )
    targets = materialize(
        source_targets(sizes.select("source", "size"), **rules).withColumnRenamed(
            "source", "target_source"
        )
    )
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        sizes.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
        .withColumn("rate", rate)
        .withColumn(
            "copies",
            F.floor("rate")
            + (F.col("coin") < F.col("rate") - F.floor("rate")).cast("long"),
        )
        .select("row", "size", "source_size", "target", "rate", "copies")
    )


def mix(docs: DataFrame, **rules) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the plan takes it."""
    copies = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return plan_mix(docs, **rules).select("row", copies.alias("copy")).select("row.*")
