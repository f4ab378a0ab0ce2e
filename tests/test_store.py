"""The tables in the catalog: days, versions, compaction under readers, replays, retention."""

import threading
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import maintenance, rollups
from pulsegrid.plans.views import register_views
from pulsegrid.sources.files import Files
from pulsegrid.sources.tables import TableStore

AT_ONCE = {"settle": timedelta(days=-9999)}
AS_OF = datetime(2025, 4, 12)
NEVER_YOUNG = datetime(2100, 1, 1)


def readings(spark, *rows):
    return spark.createDataFrame(rows, "timestamp timestamp, server_id string, cpu_usage_percent double")


def filled(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    t0 = datetime(2025, 1, 1)
    for n in range(4):
        store.append(
            "server_metrics",
            readings(spark, *[(t0 + timedelta(days=d, hours=n), f"srv-{h}", float(h))
                              for d in (0, 1, 100) for h in range(5)]),
            f"a-{n}",
        )
    return store


def contents(store, name="server_metrics"):
    return sorted(map(str, store.read(name).drop("batch_id").collect()))


def files(store, day):
    return sorted(f.rsplit("/", 1)[1] for f in store.read("server_metrics", day, day).inputFiles())


def test_compaction_keeps_rows_and_folds_closed_days(spark, tmp_path):
    store = filled(spark, tmp_path)
    before, day = contents(store), datetime(2025, 1, 1).date()
    assert len(files(store, day)) >= 4
    done = maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE)
    assert [str(d) for d in done] == ["2025-01-01", "2025-01-02"]
    assert contents(store) == before
    assert len(files(store, day)) == 1 and "/_days/" in store.location("server_metrics", day)
    assert len(files(store, datetime(2025, 4, 11).date())) >= 4
    assert maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE) == []
    # A late batch goes to the day's new folder, and is folded in by the next run.
    store.append("server_metrics", readings(spark, (datetime(2025, 1, 1, 9), "late", 1.0)), "a-9")
    assert len(files(store, day)) == 2
    assert maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE) == [day]
    assert len(files(store, day)) == 1 and store.read("server_metrics").count() == len(before) + 1


def test_readers_never_miss_a_row_while_days_are_switched(spark, tmp_path):
    store = filled(spark, tmp_path)
    register_views(store)
    ask = "SELECT count(*) AS n FROM server_metrics WHERE event_date < DATE'2025-02-01'"
    whole, seen, stop = spark.sql(ask).first().n, [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.sql(ask).first().n)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(3):
        moment = readings(spark, (datetime(2025, 4, 11, 3), "new", 1.0))
        store.append("server_metrics", moment, f"b-{n}")
        late = store.read("server_metrics").where("event_date < DATE'2025-02-01'").limit(0)
        store.append("server_metrics", late.select("timestamp", "server_id"), f"c-{n}")
        for day in store.days("server_metrics")[:2]:  # a version each, whether there is news or not
            target = f"{store.path('server_metrics')}/_days/event_date={day}/{datetime.now():{maintenance.STAMP}}"
            maintenance._rewrite(store, "server_metrics", day, target, 10)
            store.switch_day("server_metrics", day, target)
    stop.set()
    reader.join()
    assert len(seen) > 3 and set(seen) == {whole}


def test_a_run_that_dies_leaves_the_day_as_it_was(spark, tmp_path, monkeypatch):
    store = filled(spark, tmp_path)
    before = contents(store)

    def die(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(TableStore, "switch_day", die)
    with pytest.raises(RuntimeError):
        maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE)
    monkeypatch.undo()
    assert contents(store) == before
    assert len(maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE)) == 2
    assert contents(store) == before


def test_a_day_that_changes_meanwhile_is_left(spark, tmp_path, monkeypatch):
    store = filled(spark, tmp_path)
    real, late = maintenance._rewrite, readings(spark, (datetime(2025, 1, 1, 9), "late", 1.0))

    def slow(store, name, day, *rest):
        real(store, name, day, *rest)
        if day == late.first().timestamp.date():
            store.append(name, late, "late-0")

    monkeypatch.setattr(maintenance, "_rewrite", slow)
    done = maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE)
    assert [str(d) for d in done] == ["2025-01-02"]
    assert store.read("server_metrics").where("server_id = 'late'").count() == 1


def test_replaced_folders_go_and_late_writes_are_saved(spark, tmp_path):
    store = filled(spark, tmp_path)
    before, day = contents(store), datetime(2025, 1, 1).date()
    maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE)
    # a write that was planned before the switch ends behind it, in the old folder
    late = store.read("server_metrics", day, day).limit(1).drop("event_date").withColumn("server_id", F.lit("late"))
    old = f"{store.path('server_metrics')}/event_date={day}"
    late.coalesce(1).write.mode("append").parquet(old)
    assert maintenance.drop_replaced(store, "server_metrics", datetime(2000, 1, 1)) == []
    gone = maintenance.drop_replaced(store, "server_metrics", NEVER_YOUNG)
    assert len(gone) == 2 and not Path(old).exists()
    assert store.read("server_metrics").where("server_id = 'late'").count() == 1
    assert store.read("server_metrics").count() == len(before) + 1
    assert maintenance.drop_replaced(store, "server_metrics", NEVER_YOUNG) == []


def test_young_days_are_left_alone(spark, tmp_path):
    store = filled(spark, tmp_path)
    assert maintenance.compact(store, "server_metrics", AS_OF) == []


def test_retention_drops_whole_days(spark, tmp_path):
    store = filled(spark, tmp_path)
    maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE)
    as_of = datetime(2025, 4, 2, 15)
    kept = maintenance.retention_kept(store.read("server_metrics"), as_of).count()
    gone = maintenance.drop_expired(store, "server_metrics", as_of)
    assert [str(d) for d in gone] == ["2025-01-01"]
    assert store.read("server_metrics").count() == kept == 40
    assert not list(tmp_path.glob("lake/server_metrics/**/event_date=2025-01-01"))


def test_another_application_finds_the_days_again(spark, tmp_path):
    store = filled(spark, tmp_path)
    maintenance.compact(store, "server_metrics", AS_OF, **AT_ONCE)
    maintenance.drop_replaced(store, "server_metrics", NEVER_YOUNG)
    before = contents(store)
    other = TableStore(spark, store.root, "another_catalog").create()
    assert contents(other) == before
    assert other.days("server_metrics") == store.days("server_metrics")


def test_writes_of_others_are_seen_without_registering_again(spark, tmp_path):
    store = filled(spark, tmp_path)
    register_views(store)
    kept, named = store.read("server_metrics"), spark.table("server_metrics")
    n = kept.count()
    day = readings(spark, (datetime(2025, 1, 1, 5), "b", 1.0), (datetime(2025, 8, 1, 5), "b", 1.0))
    TableStore(spark, store.root).append("server_metrics", day, "other-0")
    assert kept.count() == named.count() == spark.sql("SELECT * FROM server_metrics").count() == n + 2


def test_a_view_lists_the_day_it_is_asked_for(spark, tmp_path):
    store = filled(spark, tmp_path)
    register_views(store)
    found = spark.sql("SELECT * FROM server_metrics WHERE event_date = DATE'2025-01-02'")
    assert {f.split("event_date=")[1][:10] for f in found.inputFiles()} == {"2025-01-02"}


def test_only_a_batch_that_may_be_a_replay_is_looked_for(spark, tmp_path, monkeypatch):
    store, looked = filled(spark, tmp_path), []
    real = TableStore.remove_batch
    monkeypatch.setattr(TableStore, "remove_batch", lambda self, *a: (looked.append(a[1]), real(self, *a)))
    row = readings(spark, (datetime(2025, 1, 1), "x", 1.0))
    for batch in ("a-4", "a-5", "a-5", "b-0", "b-1"):
        store.append("server_metrics", row, batch)
    assert looked == ["a-5", "b-0"]
    assert store.read("server_metrics").where("server_id = 'x'").count() == 4
    again = TableStore(spark, store.root).create()
    again.append("server_metrics", row, "b-1")
    assert looked[-1] == "b-1" and store.read("server_metrics").where("server_id = 'x'").count() == 4


def test_states_of_late_replayed_and_reordered_batches(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    t0 = datetime(2025, 10, 2)
    from pulsegrid.operators.states import STATES, partial_states
    _, key, values = STATES["server_states"]
    batches = [[(0, 1.0), (10, 3.0)], [(600, 5.0), (700, None)], [(5, 7.0)], [(601, 9.0)]]
    for number in (1, 0, 3, 2, 2, 0):  # out of order, the last ones again
        rows = readings(spark, *[(t0 + timedelta(minutes=m), f"srv-{m % 2}", v) for m, v in batches[number]])
        if not store.read("server_metrics").where(F.col("batch_id") == f"a{number}-0").count():
            store.append("server_metrics", rows, f"a{number}-0")
        store.append("server_states", partial_states(rows, key, values), f"a{number}-0")
    batch = rollups.server_hourly(store.read("server_metrics"))
    got = rollups.hourly_from_states(store, "server_metrics_hourly").select(*batch.columns)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0 and batch.count() > 2
    # closed days are folded into one row per bucket and key, with the same sums
    store.append("server_states", partial_states(readings(spark, (t0, "srv-0", 2.0)), key, values), "b-0")
    before, rows = sorted(map(str, got.collect())), store.read("server_states").count()
    maintenance.compact(store, "server_states", AS_OF + timedelta(days=999), **AT_ONCE)
    assert store.read("server_states").count() < rows
    assert sorted(map(str, got.collect())) == before


def test_the_history_reads_one_day_of_readings(spark, tmp_path):
    from pulsegrid.operators.series import training_history
    from pulsegrid.operators.states import history_from_states
    store = TableStore(spark, str(tmp_path / "lake")).create()
    t0 = datetime(2025, 10, 2)
    rows = [(t0 + timedelta(minutes=7 * m), f"srv-{m % 3}", float(m % 64)) for m in range(4000)]
    store.append("server_metrics", readings(spark, *rows), "a-0")
    rollups.rebuild_states(store, "server_states")
    metrics, servers = ["cpu_usage_percent"], store.read("server_metrics")
    for as_of in (t0 + timedelta(days=18, minutes=33), t0 + timedelta(days=18)):
        for width in ("5min", "15min", "1hour"):
            want = training_history(servers, metrics, 14, as_of, width)
            got = history_from_states(store.read("server_states"), servers, metrics, 14, as_of, width)
            got = got.select(*want.columns)
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    opened = {f.split("event_date=")[1][:10] for f in got.inputFiles() if "server_metrics" in f}
    assert opened == {"2025-10-06"}
    with pytest.raises(ValueError):
        history_from_states(store.read("server_states"), servers, metrics, 14, as_of, "1min")
