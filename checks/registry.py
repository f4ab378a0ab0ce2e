"""Query registry and the SQL building blocks shared by the counterparts."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.clock import interval, moment
from pulsegrid.operators.states import STATES, partial_states
from pulsegrid.session import prepare
from pulsegrid.sources import samples

QUERIES: dict = {}
SQL: dict[str, str] = {}


class Inputs:
    """The driver's tables as telemetry, with the moment questions are asked at."""

    def __init__(self, spark, folder: str):
        self.spark = prepare(spark)
        self.events = samples.read_events(spark, folder)

    @cached_property
    def servers(self):
        return samples.server_metrics(self.events)

    @cached_property
    def applications(self):
        return samples.application_metrics(self.events)

    @cached_property
    def as_of(self):
        """Newest event. One value on the driver, so that time filters reach the scan as
        literals; a dashboard passes the present moment instead."""
        return moment(samples.newest(self.events)).cast("timestamp_ntz")

    @property
    def month(self):
        """Panel range: the last 30 days, which is all of the table."""
        return self.as_of - interval("30 days"), self.as_of


def rounded(df: DataFrame, sums: bool = False) -> DataFrame:
    """Doubles to six decimals.

    Engines add up in different orders, and an average can lie exactly half-way between two
    sixth decimals. With ``sums`` that noise is settled at nine decimals first.
    """

    def column(name: str, kind: str) -> str:
        if kind != "double":
            return f"`{name}`"
        inner = f"round(`{name}`, 9)" if sums else f"`{name}`"
        return f"round({inner}, 6) AS `{name}`"

    return df.selectExpr(*(column(name, kind) for name, kind in df.dtypes))


def settled(expression: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"round(CAST({expression} AS DECIMAL(28, 9)), {digits})::DOUBLE"


def query(name: str, sql: str | None = None, sums: bool = False):
    """Register a query; ``sums`` marks those that add doubles up."""

    def register(function):
        def run(spark, folder: str) -> DataFrame:
            return rounded(function(Inputs(spark, folder)), sums)

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return function

    return register


def batch_states(rows: DataFrame, name: str, batches: int = 3) -> DataFrame:
    """Partial states as ingest stores them: those of each of some batches, in any order."""
    _, key, values = STATES[name]
    batch = F.pmod(F.xxhash64("event_id"), F.lit(batches))
    parts = [partial_states(rows.where(batch == k), key, values) for k in range(batches)]
    return reduce(DataFrame.unionByName, parts)


AS_OF = "(SELECT max(ts) FROM events)"
MONTH = f'"timestamp" BETWEEN {AS_OF} - INTERVAL 30 DAY AND {AS_OF}'
HOUR = "time_bucket(INTERVAL 1 HOUR, \"timestamp\")"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
SERVER_ID = "'srv-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 3, '0')"

SERVERS = f"""
s AS (
  SELECT event_id, ts AS "timestamp", {SERVER_ID} AS server_id,
         CASE WHEN user_id % 7 <> 0 THEN 'R0' || CAST(user_id % 5 + 1 AS VARCHAR) END AS rack_id,
         'zone-' || CAST(user_id % 2 + 1 AS VARCHAR) AS datacenter_zone,
         least(value, 100.0::DOUBLE) AS cpu_usage_percent,
         least(value * 0.5::DOUBLE + 10, 100.0::DOUBLE) AS memory_usage_percent,
         value * 0.1::DOUBLE + 30 AS cpu_temperature_celsius,
         value + 200 AS power_consumption_watts,
         value * 2 AS network_rx_mbps, value * 3 AS network_tx_mbps,
         value * 0.4::DOUBLE AS disk_read_mbps, value * 0.3::DOUBLE AS disk_write_mbps
  FROM events)"""

APPLICATIONS = f"""
app AS (
  SELECT event_id, ts AS "timestamp", event_type AS service_name,
         value * 10 AS request_rate_per_sec, value * 2 AS response_time_p95_ms,
         value * 4 AS response_time_p99_ms,
         least(value * 0.1::DOUBLE, 100.0::DOUBLE) AS error_rate_percent,
         {K} AS error_count
  FROM events)"""


def models(servers: str = "SELECT DISTINCT server_id FROM s") -> str:
    return f"""
m AS (
  SELECT server_id AS entity_id, metric_name, level, spread
  FROM ({servers})
  CROSS JOIN (VALUES ('cpu_usage_percent', 50.0::DOUBLE, 15.0::DOUBLE),
                     ('memory_usage_percent', 35.0::DOUBLE, 12.0::DOUBLE),
                     ('cpu_temperature_celsius', 35.0::DOUBLE, 4.0::DOUBLE))
       AS shape(metric_name, level, spread))"""


MODELS = models()
# Two servers without a model, for the questions about missing ones.
UNTRAINED = ("srv-009", "srv-010")
SOME_MODELS = models(f"SELECT DISTINCT server_id FROM s WHERE server_id NOT IN {UNTRAINED}")


def long_form(source: str = "s", extra: str = "") -> str:
    return " UNION ALL ".join(
        f'SELECT event_id, server_id AS entity_id, "timestamp"{extra}, '
        f"'{metric}' AS metric_name, {metric} AS actual_value FROM {source}"
        for metric in ("cpu_usage_percent", "memory_usage_percent", "cpu_temperature_celsius")
    )


def scored(source: str = "s", extra: str = "") -> str:
    carried = "".join(f", l.{c.strip()}" for c in extra.split(",") if c.strip())
    return f"""
l AS ({long_form(source, extra)}),
e AS (
  SELECT l.event_id, l.entity_id, l."timestamp", l.metric_name, l.actual_value{carried}, m.spread,
         m.entity_id IS NOT NULL AS model_found,
         m.level + 0.001::DOUBLE * ((epoch_us(l."timestamp")
           - epoch_us(TIMESTAMP '2024-01-15')) / 1e6::DOUBLE / 3600) AS trend,
         CASE WHEN m.entity_id IS NOT NULL
              THEN hour(l."timestamp") * 0.1::DOUBLE END AS seasonal
  FROM l LEFT JOIN m USING (entity_id, metric_name)),
z AS (
  SELECT *, trend + seasonal AS expected_value, actual_value - (trend + seasonal) AS residual,
         (actual_value - (trend + seasonal)) / spread AS z_score FROM e),
sc AS (
  SELECT *, CASE WHEN z_score IS NOT NULL THEN least(1.0::DOUBLE, abs(z_score) / 5) END
           AS anomaly_score,
         coalesce(abs(z_score) > 3, false) AS is_anomaly FROM z)"""


SEVERITY = (
    "CASE WHEN anomaly_score >= 0.8 THEN 'critical' WHEN anomaly_score >= 0.6 THEN 'high' "
    "WHEN anomaly_score >= 0.4 THEN 'medium' ELSE 'low' END"
)
SCORED = f"{SERVERS}, {MODELS}, {scored()}"
PARTLY_SCORED = f"{SERVERS}, {SOME_MODELS}, {scored()}"
ANOMALIES = f"""{SCORED},
a AS (
  SELECT event_id, "timestamp", 'server' AS entity_type, entity_id,
         'stl_zscore_' || metric_name AS anomaly_type, {SEVERITY} AS severity, anomaly_score,
         metric_name, actual_value, expected_value, round(z_score, 4) AS z_score,
         round(residual, 4) AS residual, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal,
         3.0::DOUBLE AS threshold
  FROM sc WHERE is_anomaly)"""
