"""Line dedup by spread over sites: sketches per line hash, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import materialize

MIN_SITES = 10  # a line on that many sites is boilerplate
BAND = 0.1  # estimates within this share of the threshold are counted exactly: 6 sigma at LG_K
LG_K = 12
BLANK = " \t\r"
BROADCAST_LINES = 500_000  # rows of two hashes: about 30 MB


def site(source: Column) -> Column:
    """The site of a document; documents without a source share one."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("none"))


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: the document's key, place, 128-bit hash, length, site."""
    trimmed = F.btrim(F.col("line"), F.lit(BLANK))
    return (
        docs.select("key", "site", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
        .select("key", "site", "place", trimmed.alias("line"))
        .where(F.length("line") > 0)
        .select(
            "key",
            "site",
            "place",
            F.length("line").alias("chars"),
            F.xxhash64("line").alias("h"),
            F.xxhash64(F.lit(1), "line").alias("g"),
        )
    )


def spread_lines(lines: DataFrame, min_sites: int, band: float = BAND, lg_k: int = LG_K) -> DataFrame:
    """Hashes (h, g) of the lines on at least ``min_sites`` sites.

    Sketches merge map-side, so a line that is everywhere costs one row a task. Beyond the band
    an estimate decides; within it sites are counted exactly, again two-phase.
    """
    estimates = lines.groupBy("h", "g").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites")
    )
    sure = estimates.where(F.col("sites") > min_sites * (1 + band)).select("h", "g")
    near = estimates.where(F.col("sites").between(min_sites * (1 - band), min_sites * (1 + band)))
    exact = (
        lines.select("h", "g", "site")
        .join(near.select("h", "g"), ["h", "g"])
        .groupBy("h", "g")
        .agg(F.countDistinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return sure.unionByName(exact.select("h", "g"))


def _mask(places: Column) -> Column:
    """Booleans up to the last of some ascending places, true at each of them."""
    before = F.concat(F.array(F.lit(-1)), F.slice(places, F.lit(1), F.size(places) - 1))
    gaps = F.zip_with(places, before, lambda a, b: a - b - 1)
    return F.flatten(
        F.transform(gaps, lambda g: F.concat(F.array_repeat(F.lit(False), g), F.array(F.lit(True))))
    )


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, **sketch) -> DataFrame:
    """Every row of ``docs`` whole in ``row``, with n_lines, n_removed and the text that is kept.

    Needs doc_id, text and source; other columns pass in ``row`` whatever their names. Lines end
    at line feeds and are compared without blanks, tabs and carriage returns at their ends; blank
    lines stay. A line on ``min_sites`` sites goes from every document that has any other line; a
    document of such lines alone would be left empty and is a copy rather than a page with
    boilerplate, so it stays whole for the near-duplicate operators. A null text stays null with
    no lines. Repeated rows are treated alike. An empty table gives no rows.

    The spread lines are stored and counted first. Up to BROADCAST_LINES they are broadcast, so a
    line on every page costs no task more than its share; beyond, lines are shuffled by hash and
    adaptive execution splits the hot ones.
    """
    # rows with the same id and text may share a key: they lose the same lines
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("text").alias("text"),
        site(F.col("source")).alias("site"),
        F.xxhash64("doc_id", "text").alias("key"),
    )
    lines = _lines(keyed.select("key", "text", "site"))
    spread = materialize(spread_lines(lines, min_sites, **sketch))
    if spread.count() <= BROADCAST_LINES:
        spread = F.broadcast(spread)
    hits = (
        lines.select("key", "place", "chars", "h", "g")
        .join(spread, ["h", "g"])
        .groupBy("key")
        .agg(F.collect_set(F.struct("place", "chars")).alias("hits"))
        .select(
            F.col("key").alias("hit_key"),
            F.array_sort(F.col("hits.place")).alias("places"),
            F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["chars"]).alias("hit_chars"),
        )
        .withColumn("mask", _mask(F.col("places")))
    )
    solid = F.aggregate(
        F.split("text", "\n", -1),
        F.lit(0).cast("long"),
        lambda n, line: n + F.length(F.btrim(line, F.lit(BLANK))),
    )
    goes = F.col("hit_chars").isNotNull() & (F.col("hit_chars") < solid)
    kept = F.array_join(
        F.filter(F.split("text", "\n", -1), lambda _, k: ~F.coalesce(F.get("mask", k), F.lit(False))),
        "\n",
    )
    return keyed.join(hits, F.col("key") == F.col("hit_key"), "left").select(
        "row",
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.when(goes, F.size("places")).otherwise(0).cast("long").alias("n_removed"),
        F.when(goes, kept).otherwise(F.col("text")).alias("kept"),
    )
