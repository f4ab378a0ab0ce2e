"""Scoring against baseline models, anomaly panels, model table."""

from pyspark.sql import functions as F

from pulsegrid.config import DEFAULT_METRICS
from pulsegrid.functions.bands import severity
from pulsegrid.operators import scoring
from pulsegrid.plans import anomalies as panels
from pulsegrid.session import materialize
from pulsegrid.sources import models as model_table
from pulsegrid.sources import samples

from .registry import (
    settled,
    ANOMALIES,
    AS_OF,
    HOUR,
    K,
    MODELS,
    MONTH,
    PARTLY_SCORED,
    SCORED,
    SERVERS,
    SEVERITY,
    UNTRAINED,
    query,
)

DAY = f'"timestamp" > {AS_OF} - INTERVAL 1 DAY'


def score(t, untrained=(), carry=("event_id",), readings=None):
    return scoring.score(
        t.servers if readings is None else readings,
        materialize(samples.baseline_models(t.servers, untrained)),
        DEFAULT_METRICS,
        carry=carry,
    )


def anomalies(t):
    return scoring.anomaly_records(score(t), carry=["event_id"])


@query(
    "score_fixed_model",
    f"""WITH {PARTLY_SCORED} SELECT event_id, entity_id, metric_name, "timestamp", model_found,
        round(actual_value, 6) AS actual_value, round(trend, 6) AS trend,
        round(seasonal, 6) AS seasonal, round(expected_value, 6) AS expected_value,
        round(residual, 6) AS residual, round(z_score, 6) AS z_score,
        round(anomaly_score, 6) AS anomaly_score, is_anomaly FROM sc""",
)
def _(t):
    return score(t, UNTRAINED).drop("threshold")


@query(
    "detect_anomalies",
    f"""WITH {ANOMALIES} SELECT event_id, "timestamp", entity_type, entity_id, anomaly_type,
        severity, round(anomaly_score, 6) AS anomaly_score, metric_name,
        round(actual_value, 6) AS actual_value, round(expected_value, 6) AS expected_value,
        z_score, residual, trend, seasonal, threshold FROM a""",
)
def detect(t):
    return anomalies(t).select("*", "details.*").drop("details")


@query(
    "detection_stats",
    f"""WITH {PARTLY_SCORED}, c AS (SELECT count(*) AS total_analyzed,
          count(*) FILTER (NOT model_found) AS models_not_found,
          count(*) FILTER (model_found AND z_score IS NULL) AS undefined_scores,
          count(*) FILTER (is_anomaly) AS anomalies_detected FROM sc)
        SELECT *, round(anomalies_detected * 100.0::DOUBLE / total_analyzed, 2)
          AS detection_rate_percent FROM c""",
)
def _(t):
    return scoring.detection_stats(score(t, UNTRAINED))


@query(
    "severity_bands",
    f"""WITH {SCORED} SELECT event_id, metric_name, {SEVERITY} AS severity
        FROM sc WHERE model_found""",
)
def _(t):
    found = score(t).filter("model_found")
    return found.select(
        "event_id", "metric_name", severity(F.col("anomaly_score")).alias("severity")
    )


@query(
    "anomalies_last_hour",
    f"""WITH {ANOMALIES}, v AS (SELECT count(*) AS value FROM a WHERE {DAY})
        SELECT value, CASE WHEN value >= 30 THEN 'red' WHEN value >= 15 THEN 'orange'
          WHEN value >= 5 THEN 'yellow' ELSE 'green' END AS status FROM v""",
)
def _(t):
    return panels.anomaly_count(anomalies(t), t.as_of, "1 day")


@query(
    "critical_entities",
    f"""WITH {ANOMALIES}, v AS (
          SELECT count(DISTINCT entity_id) AS value FROM a WHERE {DAY} AND severity = 'critical')
        SELECT value, CASE WHEN value >= 1 THEN 'red' ELSE 'green' END AS status FROM v""",
)
def _(t):
    return panels.critical_entities(anomalies(t), t.as_of, "1 day")


@query(
    "anomalies_by_severity",
    f"WITH {ANOMALIES} SELECT severity, count(*) AS value FROM a WHERE {DAY} GROUP BY severity",
)
def _(t):
    return panels.by_severity(anomalies(t), t.as_of, "1 day")


@query(
    "anomalies_by_metric",
    f"""WITH {ANOMALIES} SELECT metric_name AS metric, count(*) AS value FROM a WHERE {DAY}
        GROUP BY metric_name""",
)
def _(t):
    return panels.by_metric(anomalies(t), t.as_of, "1 day")


@query(
    "anomaly_timeline",
    f"""WITH {ANOMALIES} SELECT {HOUR} AS "time", severity AS metric, count(*) AS value
        FROM a WHERE {MONTH} GROUP BY ALL""",
)
def _(t):
    return panels.timeline(anomalies(t), *t.month, "1 hour")


def _half_up(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(18, 9)), {digits}) AS DOUBLE)"


@query(
    "recent_anomalies",
    f"""WITH {ANOMALIES} SELECT "timestamp" AS "Time", entity_id AS "Entity",
        metric_name AS "Metric", severity AS "Severity", {_half_up("anomaly_score", 3)} AS "Score",
        {_half_up("actual_value", 2)} AS "Actual", {_half_up("expected_value", 2)} AS "Expected",
        {_half_up("z_score", 2)} AS "Z-Score", {_half_up("residual", 2)} AS "Residual"
        FROM a WHERE {MONTH} ORDER BY "timestamp" DESC, entity_id, metric_name LIMIT 100""",
)
def _(t):
    return panels.recent(anomalies(t), *t.month)


@query(
    "active_anomalies",
    f"""WITH {ANOMALIES}, r AS (
          SELECT a.*, {K} < 20 AS resolved FROM a JOIN events USING (event_id))
        SELECT entity_type, entity_id, anomaly_type, severity,
               round(anomaly_score, 6) AS anomaly_score, metric_name,
               round(actual_value, 6) AS actual_value, "timestamp", "timestamp" AS created_at
        FROM r WHERE NOT resolved""",
)
def _(t):
    flagged = samples.server_metrics(
        t.events, "CAST(get_json_object(props, '$.k') AS INT) < 20 AS resolved"
    )
    found = score(t, carry=("resolved",), readings=flagged)
    stored = scoring.anomaly_records(found, carry=["resolved"]).withColumn(
        "created_at", F.col("timestamp")
    )
    return (
        panels.active_anomalies(stored)
        .withColumns(
            {
                "metric_name": F.col("details.metric_name"),
                "actual_value": F.col("details.actual_value"),
            }
        )
        .drop("details")
    )


@query("anomaly_entities", f"WITH {ANOMALIES} SELECT DISTINCT entity_id FROM a")
def _(t):
    return panels.anomaly_entities(anomalies(t))


@query(
    "anomaly_metrics_of_entity",
    f"WITH {ANOMALIES} SELECT DISTINCT metric_name FROM a WHERE entity_id = 'srv-001'",
)
def _(t):
    return panels.metrics_of_entity(anomalies(t), "srv-001")


@query(
    "investigate_metric",
    sums=True,
    sql=f"""WITH {ANOMALIES},
        x AS (SELECT * FROM a WHERE entity_id = 'srv-001' AND metric_name = 'cpu_usage_percent'),
        w AS (SELECT 3 * avg(residual) AS margin FROM x),
        b AS (SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS "time",
                     avg(expected_value) AS expected FROM x WHERE {MONTH} GROUP BY 1)
        SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS "time", 'actual' AS metric,
               {settled("avg(cpu_usage_percent)")} AS value
        FROM s WHERE {MONTH} AND server_id = 'srv-001' GROUP BY 1
        UNION ALL SELECT "time", 'expected', {settled("expected")} FROM b
        UNION ALL SELECT "time", 'upper_bound', {settled("expected + margin")} FROM b, w
        UNION ALL SELECT "time", 'lower_bound', {settled("expected - margin")} FROM b, w
        UNION ALL SELECT "timestamp", 'anomaly_points', {settled("actual_value")} FROM x
          WHERE {MONTH}""",
)
def _(t):
    return panels.investigate(t.servers, anomalies(t), "srv-001", "cpu_usage_percent", *t.month)


_WEEKLY = f"""
wide AS (
  SELECT server_id, time_bucket(INTERVAL 7 DAY, "timestamp") AS week,
         count(*) AS n, avg(cpu_usage_percent) AS cpu, stddev_samp(cpu_usage_percent) AS cpu_sd,
         avg(memory_usage_percent) AS mem, stddev_samp(memory_usage_percent) AS mem_sd,
         avg(cpu_temperature_celsius) AS tmp, stddev_samp(cpu_temperature_celsius) AS tmp_sd
  FROM s GROUP BY ALL),
w AS (
  SELECT server_id AS entity_id, 'cpu_usage_percent' AS metric_name, week + INTERVAL 7 DAY AS ended,
         cpu AS v, cpu_sd AS sd, n FROM wide
  UNION ALL SELECT server_id, 'memory_usage_percent', week + INTERVAL 7 DAY, mem, mem_sd, n FROM wide
  UNION ALL SELECT server_id, 'cpu_temperature_celsius', week + INTERVAL 7 DAY, tmp, tmp_sd, n
    FROM wide)"""
_MODEL_COLUMNS = f"""'stl_zscore' AS method_name, entity_id, metric_name, ended AS trained_at,
  {settled("v")} AS trend_last_value, {settled("sd")} AS residual_std,
  CAST(n AS INTEGER) AS n_training_points"""
_SHOWN = (
    "method_name",
    "entity_id",
    "metric_name",
    "trained_at",
    "trend_last_value",
    "residual_std",
    "n_training_points",
)
_LATEST_SQL = f"""WITH {SERVERS}, {_WEEKLY}, r AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id, metric_name ORDER BY ended DESC) AS rn FROM w)
  SELECT {_MODEL_COLUMNS} FROM r WHERE rn = 1"""


@query("latest_model", sums=True, sql=_LATEST_SQL)
def _(t):
    return model_table.newest_models(samples.weekly_models(t.servers)).select(*_SHOWN)


@query("model_upsert", sums=True, sql=_LATEST_SQL)
def _(t):
    weekly = samples.weekly_models(t.servers)
    cut = F.expr("timestamp_ntz'2024-01-20 00:00:00'")
    stored = model_table.newest_models(weekly.filter(F.col("trained_at") <= cut))
    incoming = weekly.filter(F.col("trained_at") > cut)
    return model_table.upsert_models(stored, incoming).select(*_SHOWN)


@query(
    "fresh_models",
    sums=True,
    sql=f"""WITH {SERVERS}, {_WEEKLY} SELECT {_MODEL_COLUMNS} FROM w
        WHERE ended > {AS_OF} - INTERVAL 14 DAY""",
)
def _(t):
    weekly = samples.weekly_models(t.servers)
    return model_table.fresh_models(weekly, 14 * 86400, t.as_of).select(*_SHOWN)


@query(
    "model_documents",
    sums=True,
    sql=f"""WITH {SERVERS}, {_WEEKLY} SELECT
        'anomaly:model:stl_zscore:' || entity_id || ':' || metric_name AS key,
        {_MODEL_COLUMNS} FROM w""",
)
def _(t):
    documents = model_table.to_documents(samples.weekly_models(t.servers))
    back = model_table.from_documents(documents)
    key = model_table.model_key(*(F.col(c) for c in model_table.KEY))
    return back.select(
        key.alias("key"), *(F.col(c) for c in _SHOWN)
    ).withColumn("trained_at", F.col("trained_at").cast("timestamp_ntz"))
