"""Row-level operators: parsing, routing, rules, derived columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.config import DEFAULT_METRICS
from pulsegrid.functions import bands
from pulsegrid.functions.clock import bucket, format_iso, parse_iso, slot_of_day
from pulsegrid.functions.documents import decode, encode, field_number, field_text
from pulsegrid.operators import quality
from pulsegrid.operators.series import to_long
from pulsegrid.sources import samples

from .registry import K, SERVER_ID, SERVERS, long_form, query

KIND = """CASE WHEN {k} = 0 THEN 'malformed_json'
  WHEN event_type IN ('error', 'signup') THEN 'unknown_type'
  WHEN event_type <> 'view' AND value > 100 THEN 'cpu_usage_percent_out_of_range' END""".format(
    k=K
)
ROUTE = f"""CASE WHEN ({KIND}) IS NOT NULL THEN 'dead_letter'
  WHEN event_type = 'view' THEN 'application_metric' ELSE 'server_metric' END"""


@query(
    "route_counts",
    f"""WITH r AS (SELECT {ROUTE} AS route, {KIND} AS reason FROM events)
        SELECT route, reason, count(*) AS messages FROM r GROUP BY ALL""",
)
def _(t):
    return quality.routed_counts(quality.route_messages(samples.messages(t.events)))


@query(
    "dead_letter",
    f"""SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS stamp, {SERVER_ID} AS server_id,
          event_type AS service_name, round(value, 6) AS cpu, {K} = 0 AS unreadable,
          {KIND} AS reason FROM events WHERE ({KIND}) IS NOT NULL""",
)
def _(t):
    dead = quality.dead_letters(quality.route_messages(samples.messages(t.events)))
    text = F.regexp_replace("raw", "^}", "")  # whole behind its stray first character
    return dead.select(
        F.get_json_object(text, "$.timestamp").alias("stamp"),
        F.get_json_object(text, "$.server_id").alias("server_id"),
        F.get_json_object(text, "$.service_name").alias("service_name"),
        F.get_json_object(text, "$.cpu_usage_percent").cast("double").alias("cpu"),
        F.col("raw").startswith("}").alias("unreadable"),
        "reason",
    )


@query(
    "routed_server_records",
    f"""SELECT ts AS "timestamp", 'srv-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 3, '0')
          AS server_id, round(value, 6) AS cpu_usage_percent,
        round(least(value * 0.5::DOUBLE + 10, 100), 6) AS memory_usage_percent,
        round(value * 0.1::DOUBLE + 30, 6) AS cpu_temperature_celsius, CAST(NULL AS INTEGER)
          AS fan_speed_rpm FROM events WHERE ({ROUTE}) = 'server_metric'""",
)
def _(t):
    records = quality.server_records(quality.route_messages(samples.messages(t.events)))
    return records.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "server_id",
        *DEFAULT_METRICS,
        "fan_speed_rpm",
    )


@query(
    "check_ranges",
    """SELECT event_id, 'cpu_usage_percent_out_of_range' AS violation FROM events
         WHERE value NOT BETWEEN 0 AND 100
       UNION ALL SELECT event_id, 'memory_usage_percent_out_of_range' FROM events
         WHERE value * 0.5::DOUBLE + 10 NOT BETWEEN 0 AND 100
       UNION ALL SELECT event_id, 'disk_usage_percent_out_of_range' FROM events
         WHERE value * 1.5::DOUBLE - 10 NOT BETWEEN 0 AND 100""",
)
def _(t):
    raw = t.events.select(
        "event_id",
        F.col("value").alias("cpu_usage_percent"),
        (F.col("value") * 0.5 + 10).alias("memory_usage_percent"),
        (F.col("value") * 1.5 - 10).alias("disk_usage_percent"),
    )
    rules = [quality.in_bounds(c, 0, 100) for c in raw.columns[1:]]
    return quality.violations(raw, rules).select("event_id", "violation")


_WORD = """CASE event_type WHEN 'click' THEN 'low' WHEN 'error' THEN 'critical'
  WHEN 'purchase' THEN 'urgent' WHEN 'view' THEN NULL ELSE 'medium' END"""


def _word():
    kind = F.col("event_type")
    return (
        F.when(kind == "click", "low")
        .when(kind == "error", "critical")
        .when(kind == "purchase", "urgent")
        .when(kind == "view", None)
        .otherwise("medium")
    )


@query(
    "check_domain",
    f"""SELECT event_id, ({_WORD}) AS severity, 'severity_not_allowed' AS violation FROM events
        WHERE ({_WORD}) NOT IN ('low', 'medium', 'high', 'critical')""",
)
def _(t):
    rows = t.events.select("event_id", _word().alias("severity"))
    return quality.violations(rows, [quality.one_of("severity", bands.SEVERITIES)])


@query(
    "check_not_null",
    """SELECT event_id, 'server_id_missing' AS violation FROM events WHERE user_id % 7 = 0
       UNION ALL SELECT event_id, 'entity_type_missing' FROM events WHERE event_type = 'error'""",
)
def _(t):
    rows = t.events.select(
        "event_id",
        "ts",
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("server_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("entity_type"),
    )
    rules = [quality.not_null(c) for c in ("ts", "server_id", "entity_type")]
    return quality.violations(rows, rules).select("event_id", "violation")


@query("json_decode", f"SELECT event_id, {K} AS k FROM events")
def _(t):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return t.events.select("event_id", decode(F.col("props"), schema)["k"].alias("k"))


@query(
    "json_encode",
    "SELECT event_id, event_type AS service, round(value, 6) AS reading FROM events",
)
def _(t):
    document = encode("event_type", "value", "event_id")
    return t.events.select(document.alias("d")).select(
        field_text(F.col("d"), "event_id").cast("long").alias("event_id"),
        field_text(F.col("d"), "event_type").alias("service"),
        field_number(F.col("d"), "value").alias("reading"),
    )


@query(
    "json_extract",
    f"""SELECT event_id, CAST({K} AS VARCHAR) AS k_text, CAST({K} AS DOUBLE) AS k_number,
        CAST(NULL AS DOUBLE) AS absent, CAST(NULL AS DOUBLE) AS not_a_number FROM events""",
)
def _(t):
    props = F.col("props")
    return t.events.select(
        "event_id",
        field_text(props, "k").alias("k_text"),
        field_number(props, "k").alias("k_number"),
        field_number(props, "absent").alias("absent"),
        field_number(encode("event_type"), "event_type").alias("not_a_number"),
    )


@query(
    "parse_iso",
    f"""SELECT event_id, CASE WHEN {K} % 3 = 0 THEN ts WHEN {K} % 3 = 1 THEN ts - INTERVAL 2 HOUR
        END AS parsed FROM events""",
)
def _(t):
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    k = field_number(F.col("props"), "k").cast("int")
    text = (
        F.when(k % 3 == 0, F.concat(local, F.lit("Z")))
        .when(k % 3 == 1, F.concat(local, F.lit("+02:00")))
        .otherwise(F.concat(F.lit("no time "), local))
    )
    return t.events.select("event_id", parse_iso(text).cast("timestamp_ntz").alias("parsed"))


@query(
    "format_iso",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS text FROM events",
)
def _(t):
    return t.events.select("event_id", format_iso(F.col("ts").cast("timestamp")).alias("text"))


@query(
    "time_bucket",
    """SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS five_minutes,
       time_bucket(INTERVAL 1 HOUR, ts) AS hour, time_bucket(INTERVAL 7 DAY, ts) AS week,
       time_bucket(INTERVAL 2 DAY, ts) AS two_days FROM events""",
)
def _(t):
    return (
        t.events.withColumn("five_minutes", bucket("ts", "5 minutes"))
        .withColumn("hour", bucket("ts", "1 hour"))
        .withColumn("week", bucket("ts", "1 week"))
        .withColumn("two_days", bucket("ts", "2 days"))
        .select("event_id", "five_minutes", "hour", "week", "two_days")
    )


@query(
    "seasonal_index",
    """SELECT event_id, CAST(((hour(ts) * 60 + minute(ts)) // 5) % 288 AS INTEGER) AS five_minutes,
       CAST(((hour(ts) * 60 + minute(ts)) // 60) % 24 AS INTEGER) AS hourly,
       CAST(((hour(ts) * 60 + minute(ts)) // 15) % 40 AS INTEGER) AS short_cycle,
       CAST(NULL AS INTEGER) AS below_a_minute FROM events""",
)
def _(t):
    slot = lambda step, size: F.expr(slot_of_day("ts", step, size))
    return t.events.select(
        "event_id",
        slot(300, 288).alias("five_minutes"),
        slot(3600, 24).alias("hourly"),
        slot(900, 40).alias("short_cycle"),
        slot(30, 24).alias("below_a_minute"),
    )


@query(
    "unpivot_metrics",
    f"""WITH {SERVERS}, l AS ({long_form()}) SELECT event_id, entity_id AS server_id, "timestamp",
        metric_name, round(actual_value, 6) AS value FROM l""",
)
def _(t):
    keys = ["event_id", "server_id", "timestamp"]
    return to_long(t.servers, keys, [*DEFAULT_METRICS, "fan_speed_rpm"])


@query(
    "threshold_status",
    """SELECT event_id,
       CASE WHEN least(value, 100) >= 80 THEN 'red' WHEN least(value, 100) >= 60 THEN 'yellow'
         ELSE 'green' END AS cpu,
       CASE WHEN least(value * 0.5::DOUBLE + 10, 100) >= 85 THEN 'red'
         WHEN least(value * 0.5::DOUBLE + 10, 100) >= 70 THEN 'yellow' ELSE 'green' END AS memory,
       CASE WHEN value * 0.1::DOUBLE + 30 >= 80 THEN 'red'
         WHEN value * 0.1::DOUBLE + 30 >= 70 THEN 'orange'
         WHEN value * 0.1::DOUBLE + 30 >= 60 THEN 'yellow' ELSE 'green' END AS temperature,
       CASE WHEN value * 2 >= 200 THEN 'red' WHEN value * 2 >= 100 THEN 'yellow'
         ELSE 'green' END AS p95,
       CASE WHEN value * 0.1::DOUBLE >= 5 THEN 'red' WHEN value * 0.1::DOUBLE >= 1 THEN 'yellow'
         ELSE 'green' END AS errors FROM events""",
)
def _(t):
    value = F.col("value")
    status = bands.panel_status
    return t.events.select(
        "event_id",
        status(F.least(value, F.lit(100.0)), "cpu_usage_percent").alias("cpu"),
        status(F.least(value * 0.5 + 10, F.lit(100.0)), "memory_usage_percent").alias("memory"),
        status(value * 0.1 + 30, "cpu_temperature_celsius").alias("temperature"),
        status(value * 2, "response_time_p95_ms").alias("p95"),
        status(value * 0.1, "error_rate_percent").alias("errors"),
    )
