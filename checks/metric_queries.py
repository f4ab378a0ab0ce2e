"""Infrastructure panels, views, rollups, filters."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.clock import in_range, interval, within_last
from pulsegrid.operators.series import latest_per_key, summarize
from pulsegrid.plans import infrastructure as infra
from pulsegrid.plans import maintenance, rollups
from pulsegrid.plans.training import discover_entities

from .registry import APPLICATIONS, AS_OF, HOUR, MONTH, SERVERS, batch_states, query, settled

DAY = f'"timestamp" > {AS_OF} - INTERVAL 1 DAY'


def _status(panel_bands: list[tuple[str, int]]) -> str:
    whens = " ".join(f"WHEN value >= {floor} THEN '{name}'" for name, floor in panel_bands)
    return f"CASE WHEN value IS NULL THEN NULL {whens} ELSE 'green' END AS status"


def _average_sql(column: str, bands) -> str:
    return f"""WITH {SERVERS}, v AS (SELECT avg({column}) AS value FROM s WHERE {DAY})
        SELECT {settled("value")} AS value, {_status(bands)} FROM v"""


@query(
    "avg_cpu_now",
    sums=True,
    sql=_average_sql("cpu_usage_percent", [("red", 80), ("yellow", 60)]),
)
def _(t):
    return infra.current_average(t.servers, "cpu_usage_percent", t.as_of, "1 day")


@query(
    "avg_memory_now",
    sums=True,
    sql=_average_sql("memory_usage_percent", [("red", 85), ("yellow", 70)]),
)
def _(t):
    return infra.current_average(t.servers, "memory_usage_percent", t.as_of, "1 day")


@query(
    "avg_temperature_now",
    sums=True,
    sql=_average_sql("cpu_temperature_celsius", [("red", 80), ("orange", 70), ("yellow", 60)]),
)
def _(t):
    return infra.current_average(t.servers, "cpu_temperature_celsius", t.as_of, "1 day")


@query(
    "active_servers",
    f"WITH {SERVERS} SELECT count(DISTINCT server_id) AS value FROM s WHERE {DAY}",
)
def _(t):
    return infra.active_count(t.servers, "server_id", t.as_of, "1 day")


@query(
    "active_services",
    f"WITH {APPLICATIONS} SELECT count(DISTINCT service_name) AS value FROM app WHERE {DAY}",
)
def _(t):
    return infra.active_count(t.applications, "service_name", t.as_of, "1 day")


@query(
    "total_power_now",
    sums=True,
    sql=f"""WITH {SERVERS}, v AS (
          SELECT sum(p) AS value FROM (
            SELECT arg_max(power_consumption_watts, "timestamp") AS p
            FROM s WHERE {DAY} GROUP BY server_id))
        SELECT {settled("value")} AS value, {_status([("red", 100000), ("yellow", 50000)])} FROM v""",
)
def _(t):
    return infra.total_power_now(t.servers, t.as_of, "1 day")


@query(
    "latest_per_server",
    f"""WITH {SERVERS}, n AS (
          SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY "timestamp" DESC) AS rn
          FROM s)
        SELECT server_id, "timestamp", {settled("power_consumption_watts")} AS power_consumption_watts,
               {settled("cpu_usage_percent")} AS cpu_usage_percent, rack_id FROM n WHERE rn = 1""",
)
def _(t):
    return latest_per_key(
        t.servers, "server_id", ["power_consumption_watts", "cpu_usage_percent", "rack_id"]
    )


def _rack_sql(measure: str) -> str:
    return f"""WITH {SERVERS} SELECT "time", coalesce(rack_id, 'unknown') AS metric,
          {settled("value")} AS value FROM (
            SELECT {HOUR} AS "time", rack_id, {measure} AS value FROM s WHERE {MONTH}
            GROUP BY ALL)"""


@query("cpu_by_rack", sums=True, sql=_rack_sql("avg(cpu_usage_percent)"))
def _(t):
    return infra.rack_series(t.servers, "cpu_usage_percent", *t.month, "1 hour")


@query("memory_by_rack", sums=True, sql=_rack_sql("avg(memory_usage_percent)"))
def _(t):
    return infra.rack_series(t.servers, "memory_usage_percent", *t.month, "1 hour")


@query("power_by_rack", sums=True, sql=_rack_sql("sum(power_consumption_watts)"))
def _(t):
    return infra.rack_series(t.servers, "power_consumption_watts", *t.month, "1 hour", "sum")


@query(
    "network_by_rack",
    sums=True,
    sql=f"""WITH {SERVERS}, n AS (
          SELECT {HOUR} AS "time", rack_id, sum(network_rx_mbps) AS rx, sum(network_tx_mbps) AS tx
          FROM s WHERE {MONTH} GROUP BY ALL)
        SELECT "time", coalesce(rack_id, 'unknown') || '_rx' AS metric, {settled("rx")} AS value FROM n
        UNION ALL
        SELECT "time", coalesce(rack_id, 'unknown') || '_tx', {settled("tx")} FROM n""",
)
def _(t):
    return infra.network_by_rack(t.servers, *t.month, "1 hour")


@query(
    "top10_servers_cpu",
    sums=True,
    sql=f"""WITH {SERVERS}, top AS (
          SELECT server_id FROM s WHERE {DAY} GROUP BY server_id
          ORDER BY avg(cpu_usage_percent) DESC NULLS FIRST, server_id LIMIT 3)
        SELECT {HOUR} AS "time", server_id AS metric, {settled("avg(cpu_usage_percent)")} AS value
        FROM s WHERE {MONTH} AND server_id IN (SELECT server_id FROM top) GROUP BY ALL""",
)
def _(t):
    return infra.top_servers_series(t.servers, *t.month, "1 hour", t.as_of, "1 day", count=3)


def _service_sql(column: str) -> str:
    return f"""WITH {APPLICATIONS} SELECT {HOUR} AS "time", service_name AS metric,
        {settled(f"avg({column})")} AS value FROM app WHERE {MONTH} GROUP BY ALL"""


@query("p95_by_service", sums=True, sql=_service_sql("response_time_p95_ms"))
def _(t):
    return infra.service_series(t.applications, "response_time_p95_ms", *t.month, "1 hour")


@query("error_rate_by_service", sums=True, sql=_service_sql("error_rate_percent"))
def _(t):
    return infra.service_series(t.applications, "error_rate_percent", *t.month, "1 hour")


@query(
    "series_summary",
    sums=True,
    sql=f"""WITH series AS ({_rack_sql("avg(cpu_usage_percent)")})
        SELECT metric, {settled("avg(value)", 5)} AS mean, max(value) AS max, min(value) AS min,
               {settled("sum(value)", 5)} AS sum, arg_max(value, "time") AS last,
               arg_max(value, "time") FILTER (value IS NOT NULL) AS last_not_null
        FROM series GROUP BY metric""",
)
def _(t):
    series = infra.rack_series(t.servers, "cpu_usage_percent", *t.month, "1 hour")
    legend = summarize(series.withColumn("value", F.round(F.round("value", 9), 6)))
    return legend.withColumns({c: F.round(F.round(c, 9), 5) for c in ("mean", "sum")})


@query(
    "recent_server_health",
    f"""WITH {SERVERS} SELECT server_id, "timestamp", {settled("cpu_usage_percent")} AS cpu_usage_percent,
        {settled("memory_usage_percent")} AS memory_usage_percent,
        {settled("cpu_temperature_celsius")} AS cpu_temperature_celsius,
        {settled("power_consumption_watts")} AS power_consumption_watts, rack_id, datacenter_zone
        FROM s WHERE {DAY}""",
)
def _(t):
    return infra.recent_server_health(t.servers, t.as_of, "1 day")


@query(
    "recent_application_performance",
    sums=True,
    sql=f"""WITH {APPLICATIONS} SELECT service_name,
        {settled("avg(request_rate_per_sec)")} AS avg_request_rate,
        {settled("avg(response_time_p95_ms)")} AS avg_p95_latency,
        {settled("avg(error_rate_percent)")} AS avg_error_rate, max("timestamp") AS last_updated
        FROM app WHERE {DAY} GROUP BY service_name""",
)
def _(t):
    return infra.recent_application_performance(t.applications, t.as_of, "1 day")


_SERVER_MEASURES = f"""{settled("avg(cpu_usage_percent)")} AS avg_cpu, max(cpu_usage_percent) AS max_cpu,
        {settled("avg(memory_usage_percent)")} AS avg_memory,
        {settled("max(memory_usage_percent)")} AS max_memory,
        {settled("avg(cpu_temperature_celsius)")} AS avg_temperature,
        {settled("max(cpu_temperature_celsius)")} AS max_temperature,
        {settled("avg(power_consumption_watts)")} AS avg_power, count(*) AS sample_count"""


_SERVER_HOURS = f"WITH {SERVERS} SELECT {HOUR} AS hour, server_id, {_SERVER_MEASURES} FROM s GROUP BY ALL"


@query("server_metrics_hourly", sums=True, sql=_SERVER_HOURS)
def _(t):
    return rollups.server_hourly(t.servers)


@query("server_hourly_from_states", sums=True, sql=_SERVER_HOURS)
def _(t):
    """The hours added up from the states of several batches."""
    return rollups.server_hourly_from_states(batch_states(t.servers, "server_states"))


_APPLICATION_HOURS = f"""WITH {APPLICATIONS} SELECT {HOUR} AS hour, service_name,
        {settled("avg(request_rate_per_sec)")} AS avg_request_rate,
        {settled("avg(response_time_p95_ms)")} AS avg_p95_latency,
        {settled("max(response_time_p99_ms)")} AS max_p99_latency,
        {settled("avg(error_rate_percent)")} AS avg_error_rate,
        CAST(sum(error_count) AS BIGINT) AS total_errors, count(*) AS sample_count
        FROM app GROUP BY ALL"""


@query("application_metrics_hourly", sums=True, sql=_APPLICATION_HOURS)
def _(t):
    return rollups.application_hourly(t.applications)


@query("application_hourly_from_states", sums=True, sql=_APPLICATION_HOURS)
def _(t):
    """The hours added up from the states of several batches."""
    return rollups.application_hourly_from_states(batch_states(t.applications, "application_states"))


@query(
    "rollup_refresh",
    sums=True,
    sql=f"""WITH {SERVERS} SELECT {HOUR} AS hour, server_id, {_SERVER_MEASURES} FROM s
        WHERE {HOUR} >= {AS_OF} - INTERVAL 7 DAY
          AND {HOUR} + INTERVAL 1 HOUR <= {AS_OF} - INTERVAL 1 HOUR GROUP BY ALL""",
)
def _(t):
    window = rollups.refresh_window(t.servers, t.as_of, "7 days", "1 hour")
    return rollups.server_hourly(window)


@query(
    "retention_kept",
    f"""WITH {SERVERS} SELECT event_id, server_id, "timestamp" FROM s
        WHERE CAST("timestamp" AS DATE) >= CAST({AS_OF} AS DATE) - 10""",
)
def _(t):
    kept = maintenance.retention_kept(t.servers, t.as_of, days=10)
    return kept.select("event_id", "server_id", "timestamp")


LOOKBACKS = ("5 minutes", "15 minutes", "1 hour", "24 hours", "7 days")


@query(
    "recent_filter",
    f"""WITH {SERVERS} """
    + " UNION ALL ".join(
        f"""SELECT '{w}' AS lookback, event_id, server_id, "timestamp" FROM s
        WHERE "timestamp" > {AS_OF} - INTERVAL '{w}'"""
        for w in LOOKBACKS
    ),
)
def _(t):
    parts = [
        within_last(t.servers, w, t.as_of).select(
            F.lit(w).alias("lookback"), "event_id", "server_id", "timestamp"
        )
        for w in LOOKBACKS
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "time_range_filter",
    f"""WITH {SERVERS} SELECT event_id, server_id, "timestamp" FROM s
        WHERE "timestamp" BETWEEN {AS_OF} - INTERVAL 7 DAY AND {AS_OF}""",
)
def _(t):
    inside = in_range(t.servers, t.as_of - interval("7 days"), t.as_of)
    return inside.select("event_id", "server_id", "timestamp")


@query("discover_entities", f"WITH {SERVERS} SELECT DISTINCT server_id FROM s")
def _(t):
    return discover_entities(t.servers)
