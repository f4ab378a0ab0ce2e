"""Physical plans: what reaches the scan, what is shuffled, what is parsed how often."""

import io
import re
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.registry import Inputs
from pulsegrid.config import DEFAULT_METRICS
from pulsegrid.operators import quality, series
from pulsegrid.plans import infrastructure as infra
from pulsegrid.plans import maintenance, rollups
from pulsegrid.sources import samples
from pulsegrid.sources.models import newest_models
from pulsegrid.sources.tables import TableStore
from tests.conftest import SMALL

AS_OF = datetime(2025, 10, 2, 12, 30)


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def line(text: str, label: str) -> str:
    return " ".join(re.findall(rf"^{label}: .*$", text, re.M))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("lake"))).create()
    rows = spark.createDataFrame(
        [(AS_OF, "srv-1", 1.0)], "timestamp timestamp, server_id string, cpu_usage_percent double"
    )
    store.append("server_metrics", rows, "a-0")
    return store.read("server_metrics")


@pytest.mark.parametrize(
    "ask",
    [
        lambda t: infra.current_average(t, "cpu_usage_percent", AS_OF),
        lambda t: infra.rack_series(t, "cpu_usage_percent", AS_OF, AS_OF, "1 hour"),
        lambda t: rollups.server_hourly(rollups.refresh_window(t, AS_OF)),
        lambda t: series.training_history(t, DEFAULT_METRICS, 14, AS_OF),
    ],
)
def test_time_filters_prune_partitions_and_reach_the_scan(stored, ask):
    text = plan(ask(stored))
    assert "event_date" in line(text, "PartitionFilters")
    pushed = line(text, "PushedFilters")
    assert "GreaterThan" in pushed and "timestamp" in pushed and "Subquery" not in pushed
    assert "disk_usage_percent" not in line(text, "ReadSchema")


def test_retention_reads_kept_partitions_only(stored):
    text = plan(maintenance.retention_kept(stored, AS_OF))
    assert "event_date" in line(text, "PartitionFilters")


def test_one_scan_for_both_directions_of_traffic(spark):
    t = Inputs(spark, SMALL)
    assert plan(infra.network_by_rack(t.servers, *t.month, "1 hour")).count("Scan parquet") == 2
    # (a formatted plan names each operator twice: in the tree and in its details)


def test_busiest_servers_are_broadcast(spark):
    t = Inputs(spark, SMALL)
    text = plan(infra.top_servers_series(t.servers, *t.month, "1 hour", t.as_of, "1 day"))
    assert "BroadcastHashJoin LeftSemi" in text and "TakeOrderedAndProject" in text
    assert "SortMergeJoin" not in text


def test_history_of_all_series_is_one_scan_and_one_shuffle(spark):
    t = Inputs(spark, SMALL)
    text = plan(series.training_history(t.servers, DEFAULT_METRICS, 31, t.as_of, "1hour"))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1
    assert "partial_avg" in text


def test_messages_are_parsed_once(spark, events):
    routed = quality.route_messages(samples.messages(events))
    text = quality.server_records(routed)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_latest_per_key_sorts_no_readings(spark):
    """Even where nothing is small enough to be broadcast by itself, readings meet a hash aggregate
    and a broadcast of bounded size before anything is shuffled or sorted."""
    readings = Inputs(spark, SMALL).servers
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(series.latest_per_key(readings, "server_id", ["rack_id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2 and "SortMergeJoin" not in tree and "Window" not in tree
    depth = lambda row: len(row) - len(row.lstrip(" :+-"))
    rows = tree.splitlines()
    join = next(i for i, row in enumerate(rows) if "BroadcastHashJoin LeftSemi" in row)
    below = [row for row in rows[join + 1 :] if depth(row) > depth(rows[join])]
    assert not any("Sort" in row for row in below)
    second = next(i for i, row in enumerate(below) if "BroadcastExchange" in row)
    assert not any("Exchange" in row for row in below[:second])


def test_newest_models_are_one_pass(spark):
    schema = "method_name string, entity_id string, metric_name string, saved_at timestamp, x int"
    stored = spark.createDataFrame([], schema)
    text = plan(newest_models(stored)).split("\n\n")[0]
    assert text.count("Exchange") == 1 and "Join" not in text
