"""Training history, series measures, fits, and detection with fitted models.

The fit is compared with the decomposition written out in SQL (``seasonal_sql``).
"""

from pyspark.sql import functions as F

from pulsegrid.config import DetectionConfig, StlConfig
from pulsegrid.operators import series
from pulsegrid.operators.fitting import decompose_series
from pulsegrid.operators.scoring import anomaly_records, score
from pulsegrid.operators.states import history_from_states
from pulsegrid.plans import training
from pulsegrid.session import materialize

from .registry import AS_OF, SERVERS, SEVERITY, batch_states, long_form, query, settled
from .seasonal_sql import decomposition

STL = {"seasonal_period": 24, "trend_period": 49, "min_points": 200}
CONFIG = DetectionConfig(
    method_config=STL, history_days=31, aggregation_interval="1hour", skip_below=100
)

_BUCKET = "time_bucket(INTERVAL 1 HOUR, \"timestamp\")"


def _history(source: str) -> str:
    return f"""h AS (
  SELECT server_id AS entity_id, 'cpu_usage_percent' AS metric_name, {_BUCKET} AS "timestamp",
         avg(cpu_usage_percent) AS value FROM {source} GROUP BY ALL
  UNION ALL SELECT server_id, 'memory_usage_percent', {_BUCKET}, avg(memory_usage_percent)
    FROM {source} GROUP BY ALL
  UNION ALL SELECT server_id, 'cpu_temperature_celsius', {_BUCKET}, avg(cpu_temperature_celsius)
    FROM {source} GROUP BY ALL)"""


HISTORY = f"{SERVERS}, {_history('s')}"
# All readings by the height of their value: series from full to a few buckets, with gaps.
UNEVEN = f"""{SERVERS}, u AS (
  SELECT * REPLACE ('band-' || CAST(floor((power_consumption_watts - 200) / 25) AS BIGINT)
    AS server_id) FROM s), {_history('u')}"""
_BY = "PARTITION BY entity_id, metric_name"


def uneven(t):
    band = F.floor((F.col("power_consumption_watts") - 200) / 25).cast("string")
    return t.servers.withColumn("server_id", F.concat(F.lit("band-"), band))


def history(t, readings=None):
    return series.training_history(
        t.servers if readings is None else readings, CONFIG.metrics, CONFIG.history_days, t.as_of, CONFIG.aggregation_interval
    )


@query(
    "train_history",
    sums=True,
    sql=f"""WITH {HISTORY} SELECT entity_id, metric_name, "timestamp", {settled("value")} AS value
        FROM h""",
)
def _(t):
    return history(t)


@query(
    "history_from_states",
    sums=True,
    sql=f"""WITH {SERVERS}, recent AS (SELECT * FROM s WHERE "timestamp" > {AS_OF} - INTERVAL 10 DAY),
        {_history("recent")}
        SELECT entity_id, metric_name, "timestamp", {settled("value")} AS value FROM h""",
)
def _(t):
    """The look-back begins inside a bucket, which comes from readings; all others from states."""
    stored = batch_states(t.servers, "server_states")
    return history_from_states(stored, t.servers, CONFIG.metrics, 10, t.as_of, "1hour")


@query(
    "infer_interval",
    f"""WITH {UNEVEN}, g AS (SELECT entity_id, metric_name, epoch("timestamp")
          - lag(epoch("timestamp")) OVER ({_BY} ORDER BY "timestamp") AS gap FROM h)
        SELECT entity_id, metric_name, CAST(coalesce(floor(median(gap)), 300) AS INTEGER)
          AS interval_seconds FROM g GROUP BY ALL""",
)
def _(t):
    return series.infer_interval(history(t, uneven(t)))


@query(
    "tail_cycle",
    sums=True,
    sql=f"""WITH {HISTORY}, n AS (SELECT *, row_number() OVER ({_BY} ORDER BY "timestamp" DESC) AS back,
          count(*) OVER ({_BY}) AS size FROM h)
        SELECT entity_id, metric_name, "timestamp", {settled("value")} AS value,
          CAST(least(size, 24) - back AS INTEGER) AS position FROM n WHERE back <= 24""",
)
def _(t):
    return series.tail(history(t), 24)


@query(
    "tail_slope",
    sums=True,
    sql=f"""WITH {HISTORY}, n AS (SELECT *, row_number() OVER ({_BY} ORDER BY "timestamp") AS position,
          count(*) OVER ({_BY}) AS size FROM h)
        SELECT entity_id, metric_name, {settled("regr_slope(value, position)")} AS slope,
          count(*) AS points FROM n WHERE position > size - greatest(10, size // 5) GROUP BY ALL""",
)
def _(t):
    return series.tail_slope(history(t))


@query(
    "series_extent",
    sums=True,
    sql=f"""WITH {HISTORY} SELECT entity_id, metric_name, min("timestamp") AS training_start,
        max("timestamp") AS training_end, count(*) AS n_training_points,
        {settled('arg_max(value, "timestamp")')} AS last_value FROM h GROUP BY ALL""",
)
def _(t):
    return series.extent(history(t))


_VERDICT = """c AS (SELECT entity_id, metric_name, count(*) AS n_rows, count(value) AS n_values
    FROM h GROUP BY ALL),
  v AS (SELECT *, CASE WHEN n_rows < 100 THEN 'insufficient_data'
    WHEN n_values = 0 THEN 'no_valid_values' WHEN n_rows < 200 THEN 'below_min_points'
    WHEN n_values < 48 THEN 'below_two_periods' END AS reason FROM c),
  o AS (SELECT *, CASE WHEN reason IS NULL THEN 'ok' WHEN reason = 'insufficient_data'
    THEN 'skipped' ELSE 'failed' END AS status FROM v)"""


@query("series_validation", f"WITH {UNEVEN}, {_VERDICT} SELECT * FROM o")
def _(t):
    return series.validate(history(t, uneven(t)), 100, 200, 24)


@query(
    "training_stats",
    f"""WITH {UNEVEN}, {_VERDICT} SELECT count(DISTINCT entity_id) AS total_entities,
        count(*) AS total_models, count(*) FILTER (status = 'ok') AS successful,
        count(*) FILTER (status = 'failed') AS failed,
        count(*) FILTER (status = 'skipped') AS skipped FROM o""",
)
def _(t):
    readings = uneven(t)
    outcomes = training.train_outcomes(readings, CONFIG, t.as_of)
    return training.training_stats(training.all_outcomes(readings, outcomes, CONFIG))


@query(
    "time_grid_gaps",
    f"""WITH {HISTORY}, b AS (SELECT entity_id, metric_name, min("timestamp") AS lo,
          max("timestamp") AS hi FROM h GROUP BY ALL),
        g AS (SELECT entity_id, metric_name,
          unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS "timestamp" FROM b)
        SELECT g.* FROM g ANTI JOIN h USING (entity_id, metric_name, "timestamp")""",
)
def _(t):
    return series.grid_gaps(history(t), "1 hour")


_ON_THE_LINE = (
    'value + coalesce((nv - value) * ((epoch(step) - epoch("timestamp"))'
    ' / (epoch(nt) - epoch("timestamp"))), 0)'
)


@query(
    "filled_history",
    sums=True,
    sql=f"""WITH {HISTORY}, p AS (SELECT *, lead("timestamp") OVER ({_BY} ORDER BY "timestamp") AS nt,
          lead(value) OVER ({_BY} ORDER BY "timestamp") AS nv FROM h),
        f AS (SELECT *, unnest(generate_series("timestamp",
          coalesce(nt - INTERVAL 1 HOUR, "timestamp"), INTERVAL 1 HOUR)) AS step FROM p)
        SELECT entity_id, metric_name, step AS "timestamp", {settled(_ON_THE_LINE)} AS value
        FROM f""",
)
def _(t):
    return series.fill_gaps(history(t), "1 hour")


@query(
    "fitted_extent",
    sql=f"""WITH {HISTORY}, {_VERDICT},
        g AS (SELECT *, epoch("timestamp") - lag(epoch("timestamp"))
          OVER ({_BY} ORDER BY "timestamp") AS gap FROM h),
        x AS (SELECT entity_id, metric_name, count(*) AS n, min("timestamp") AS first,
          max("timestamp") AS last, CAST(floor(median(gap)) AS INTEGER) AS gap FROM g GROUP BY ALL)
        SELECT entity_id, metric_name, status, reason, CAST(n_rows AS INTEGER) AS n_rows,
          CASE WHEN status = 'ok' THEN CAST(n AS INTEGER) END AS n_training_points,
          CASE WHEN status = 'ok' THEN gap END AS interval_seconds,
          CASE WHEN status = 'ok' THEN first END AS training_start,
          CASE WHEN status = 'ok' THEN last END AS training_end,
          CASE WHEN status = 'ok' THEN 24 END AS cycle
        FROM o JOIN x USING (entity_id, metric_name)""",
)
def _(t):
    fitted = training.train_outcomes(t.servers, CONFIG, t.as_of)
    return fitted.select(
        "entity_id",
        "metric_name",
        "status",
        "reason",
        "n_rows",
        "n_training_points",
        "interval_seconds",
        "training_start",
        "training_end",
        F.array_size("seasonal_pattern").alias("cycle"),
    )


# The fit in SQL: every series that is long enough, decomposed, and the model it leaves.
_FITTED = f"""
placed AS MATERIALIZED (
  SELECT entity_id || '|' || metric_name AS k, count(*) OVER ({_BY}) AS n,
         row_number() OVER ({_BY} ORDER BY "timestamp") AS i, value AS y, entity_id, metric_name,
         "timestamp" FROM h JOIN o USING (entity_id, metric_name) WHERE status = 'ok'),
{decomposition("placed", STL["seasonal_period"], STL["trend_period"])},
found AS MATERIALIZED (
  SELECT placed.*, trend, seasonal, y - trend - seasonal AS resid
  FROM placed JOIN parts USING (k, i)),
fitted AS MATERIALIZED (
  SELECT entity_id, metric_name, arg_max(trend, i) AS trend_last_value,
         regr_slope(trend, i) FILTER (i > n - greatest(10, n // 5)) AS trend_slope,
         max("timestamp") AS trend_last_timestamp, avg(resid) AS residual_mean,
         stddev_samp(resid) AS residual_std, any_value(n) AS n_training_points,
         list(seasonal ORDER BY i) FILTER (i > n - {STL["seasonal_period"]}) AS pattern
  FROM found GROUP BY ALL)"""


@query(
    "decompose_series",
    sums=True,
    sql=f"""WITH {HISTORY}, {_VERDICT}, {_FITTED} SELECT entity_id, metric_name, "timestamp",
        {settled("y")} AS value, {settled("trend")} AS trend, {settled("seasonal")} AS seasonal,
        {settled("resid")} AS resid FROM found""",
)
def _(t):
    """Trend, seasonal part and residual of every bucket."""
    return decompose_series(history(t), StlConfig(**STL))


@query(
    "train_models",
    sums=True,
    sql=f"""WITH {HISTORY}, {_VERDICT}, {_FITTED} SELECT entity_id, metric_name, status,
        {settled("trend_last_value")} AS trend_last_value, {settled("trend_slope")} AS trend_slope,
        trend_last_timestamp, {settled("residual_mean")} AS residual_mean,
        {settled("residual_std")} AS residual_std,
        CAST(f.n_training_points AS INTEGER) AS n_training_points,
        CAST(unnest(range(0, len(pattern))) AS INTEGER) AS place,
        {settled("unnest(pattern)")} AS seasonal
        FROM o JOIN fitted f USING (entity_id, metric_name)""",
)
def _(t):
    """Fitted model of every series, one row for each place of its cycle."""
    fitted = training.train_outcomes(t.servers, CONFIG, t.as_of).where("status = 'ok'")
    return fitted.select(
        "entity_id",
        "metric_name",
        "status",
        "trend_last_value",
        "trend_slope",
        "trend_last_timestamp",
        "residual_mean",
        "residual_std",
        "n_training_points",
        F.posexplode("seasonal_pattern").alias("place", "seasonal"),
    )


@query(
    "detect_with_trained_models",
    sums=True,
    sql=f"""WITH {HISTORY}, {_VERDICT}, {_FITTED}, l AS ({long_form()}),
        e AS (
          SELECT l.*, l.actual_value - (trend + seasonal) AS residual, trend + seasonal AS expected_value,
                 (l.actual_value - (trend + seasonal) - residual_mean) / residual_std AS z_score
          FROM (SELECT l.*, pattern[hour(l."timestamp") % 24 + 1] AS seasonal, residual_mean, residual_std,
                  trend_last_value + trend_slope * ((epoch_us(l."timestamp")
                    - epoch_us(trend_last_timestamp)) / 1e6::DOUBLE / 3600) AS trend
                FROM l JOIN fitted USING (entity_id, metric_name)) l),
        a AS (SELECT *, least(1.0::DOUBLE, abs(z_score) / 5) AS anomaly_score FROM e WHERE abs(z_score) > 3)
        SELECT event_id, "timestamp", entity_id, metric_name, {SEVERITY} AS severity,
          {settled("anomaly_score")} AS anomaly_score, {settled("expected_value")} AS expected_value,
          {settled("z_score", 4)} AS z_score FROM a""",
)
def _(t):
    """Fit on the whole history, then score every reading against the fitted models."""
    models = materialize(training.train_models(t.servers, CONFIG, t.as_of))
    found = score(t.servers, models, CONFIG.metrics, carry=("event_id",))
    return anomaly_records(found, carry=["event_id"]).select(
        "event_id",
        "timestamp",
        "entity_id",
        "details.metric_name",
        "severity",
        "anomaly_score",
        "details.expected_value",
        "details.z_score",
    )
