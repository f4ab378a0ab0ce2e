"""Row expectations, routing by record kind, and the dead letter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import SEVERITIES
from ..functions.clock import parse_iso
from ..functions.documents import decode
from ..schemas import APPLICATION_METRICS, MESSAGE, SERVER_METRICS

SERVER, APPLICATION, DEAD = "server_metric", "application_metric", "dead_letter"
UNKNOWN_TYPE, MALFORMED = "unknown_type", "malformed_json"


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column}_missing", F.col(column).isNull())


def in_bounds(column: str, low: float, high: float) -> Rule:
    """NULL passes, as in an SQL CHECK."""
    return Rule(f"{column}_out_of_range", ~F.col(column).between(low, high))


def one_of(column: str, values: Sequence[str]) -> Rule:
    return Rule(f"{column}_not_allowed", ~F.col(column).isin(*values))


def max_length(column: str, length: int) -> Rule:
    return Rule(f"{column}_too_long", F.length(column) > length)


def server_rules() -> list[Rule]:
    return [
        not_null("timestamp"),
        not_null("server_id"),
        *(
            in_bounds(c, 0, 100)
            for c in ("cpu_usage_percent", "memory_usage_percent", "disk_usage_percent")
        ),
        max_length("server_id", 50),
        max_length("rack_id", 20),
        max_length("datacenter_zone", 20),
    ]


def application_rules() -> list[Rule]:
    return [
        not_null("timestamp"),
        not_null("service_name"),
        in_bounds("error_rate_percent", 0, 100),
        max_length("service_name", 100),
        max_length("server_id", 50),
        max_length("endpoint", 200),
    ]


def prediction_rules() -> list[Rule]:
    return [
        not_null("timestamp"),
        not_null("server_id"),
        max_length("server_id", 50),
        max_length("model_version", 50),
    ]


def anomaly_rules() -> list[Rule]:
    return [
        *(not_null(c) for c in ("timestamp", "entity_type", "entity_id", "anomaly_type")),
        one_of("severity", SEVERITIES),
        max_length("entity_type", 50),
        max_length("entity_id", 100),
        max_length("anomaly_type", 100),
    ]


def first_violation(rules: Sequence[Rule]) -> Column:
    """Name of the first broken rule, NULL for a clean row."""
    return F.coalesce(*(F.when(rule.violated, F.lit(rule.name)) for rule in rules))


def violations(df: DataFrame, rules: Sequence[Rule], column: str = "violation") -> DataFrame:
    """One row per broken rule and input row."""
    broken = F.array_compact(F.array(*(F.when(r.violated, F.lit(r.name)) for r in rules)))
    return df.withColumn(column, F.explode(broken))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, violating rows with ``reason``)."""
    judged = df.withColumn("reason", first_violation(rules))
    return (
        judged.filter(F.col("reason").isNull()).drop("reason"),
        judged.filter(F.col("reason").isNotNull()),
    )


def parse_messages(messages: DataFrame, *keep: Column) -> DataFrame:
    """Fields of every message, with ``timestamp`` as a timestamp.

    The record comes out of a generator so that filters on its fields stay above it: pushed
    through a projection they would parse the text again for every field they mention.
    """
    fields = messages.select(*keep, F.inline(F.array(decode(F.col("value"), MESSAGE))))
    return fields.withColumn("timestamp", parse_iso("timestamp"))


def route_messages(messages: DataFrame) -> DataFrame:
    """Parse ``value`` (JSON text) and give each message a ``route``.

    Keeps the text as ``raw``. A message goes to the dead letter with a ``reason`` when it is
    not readable JSON, its kind is missing or unknown, or it breaks a rule of its table; only
    the offending row goes, never its batch.
    """
    parsed = parse_messages(messages, F.col("value").alias("raw"))
    kind = F.coalesce(F.col("type"), F.lit(""))
    reason = (
        F.when(F.col("raw").isNull() | F.col("_corrupt_record").isNotNull(), MALFORMED)
        .when(kind == SERVER, first_violation(server_rules()))
        .when(kind == APPLICATION, first_violation(application_rules()))
        .otherwise(UNKNOWN_TYPE)
    )
    return parsed.withColumn("reason", reason).withColumn(
        "route", F.when(F.col("reason").isNull(), kind).otherwise(DEAD)
    )


def routed_counts(routed: DataFrame) -> DataFrame:
    """Messages per (route, reason)."""
    return routed.groupBy("route", "reason").agg(F.count("*").alias("messages"))


def _records(routed: DataFrame, route: str, schema) -> DataFrame:
    present = set(routed.columns)
    return routed.filter(F.col("route") == route).select(
        *(
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def server_records(routed: DataFrame) -> DataFrame:
    return _records(routed, SERVER, SERVER_METRICS)


def application_records(routed: DataFrame) -> DataFrame:
    return _records(routed, APPLICATION, APPLICATION_METRICS)


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == DEAD).select("raw", "reason")
