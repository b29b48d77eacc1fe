import datetime as dt
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from fixtures import late_events
from pickwise.operators import sequence as sq
from pickwise.sources import tables as src
from pickwise.streaming import live


def _events_pd(spark):
    return src.load(spark, SF001, "events").toPandas().sort_values(["user_id", "ts", "event_id"])


def test_sessions_match_pandas(spark):
    ev = _events_pd(spark)
    gap = pd.Timedelta(minutes=30)
    ev["new"] = ev.groupby("user_id")["ts"].diff().isna() | (ev.groupby("user_id")["ts"].diff() > gap)
    ev["sn"] = ev.groupby("user_id")["new"].cumsum()
    want = sorted((int(u), int(s), len(g)) for (u, s), g in ev.groupby(["user_id", "sn"]))
    got = sorted((r.user_id, r.session_no, r.events) for r in sq.sessions(src.load(spark, SF001, "events")).collect())
    assert got == want


def test_next_item_match_pandas(spark):
    ev = _events_pd(spark)
    ev["item"] = ev.props.str.extract(r'"k": (\d+)').astype(int)
    ev["nxt"] = ev.groupby("user_id")["item"].shift(-1)
    tr = ev.dropna(subset=["nxt"]).groupby(["item", "nxt"]).size()
    got = {(r.item_id, r.next_id): r.n for r in sq.next_item(src.load(spark, SF001, "events")).collect()}
    assert got == {(int(a), int(b)): int(n) for (a, b), n in tr.items()}


def test_sessions_split_over_many_buckets(spark):
    # one user holding every event: the global order spreads it over buckets
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=20 * i + (40 if i % 10 == 0 else 0)), 7, "view",
             1.0, '{"k": 1}') for i in range(400)]
    ev = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                     "value double, props string").repartition(16)
    s = sq.sessions(ev).collect()
    assert sum(r.events for r in s) == 400
    assert sorted(r.session_no for r in s) == list(range(1, len(s) + 1))
    assert len(s) == 40


def test_late_events_are_dropped(spark):
    files = late_events()
    d = tempfile.mkdtemp(prefix="late-", dir="/tmp")
    cols = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    flat = os.path.join(d, "flat")
    os.makedirs(flat)
    for k, rows in enumerate(files):
        sub = os.path.join(d, f"p{k}")
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(sub)
        f = [x for x in os.listdir(sub) if x.endswith(".parquet")][0]
        os.link(os.path.join(sub, f), os.path.join(flat, f"{k}.parquet"))
        os.utime(os.path.join(flat, f"{k}.parquet"), (1_700_000_000 + k, 1_700_000_000 + k))
    stream = live.event_stream(spark, flat, files_per_trigger=1, pattern="*.parquet")
    out = live.run_upserts(live.stream_counts(stream), "late", ["window_start", "event_type"])
    got = {(r.window_start.hour, r.event_type): r.n for r in out.collect()}
    # 10:30 and 10:50 arrive after their window was closed and evicted: dropped
    assert got == {(10, "view"): 2, (11, "click"): 1, (11, "view"): 1, (12, "view"): 2}


def test_user_features_gap(spark):
    f = sq.user_features(src.load(spark, SF001, "events"), "2024-01-31").collect()
    ev = _events_pd(spark)
    g = ev.groupby("user_id")["ts"]
    for r in f[:5]:
        span = (g.max()[r.user_id] - g.min()[r.user_id]).total_seconds()
        assert abs(r.mean_gap_s - span / (r.events - 1)) < 1e-6
        assert len(r.last_items) == min(3, r.events)


def _one_by_one(spark, rows, cols, folder):
    """The rows as a table folder, a file for each row, in order."""
    os.makedirs(folder)
    for k, row in enumerate(rows):
        sub = tempfile.mkdtemp(prefix="part-", dir="/tmp")
        spark.createDataFrame([row], cols).coalesce(1).write.mode("overwrite").parquet(sub)
        f = [x for x in os.listdir(sub) if x.endswith(".parquet")][0]
        to = os.path.join(folder, f"part-{k:04d}.parquet")
        os.link(os.path.join(sub, f), to)
        os.utime(to, (1_700_000_000 + k, 1_700_000_000 + k))


def test_streams_agree_over_one_file_many_files_and_many_batches(spark, tmp_path):
    cols = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    day = dt.datetime(2024, 1, 1, 10)
    mins = [0, 20, 15, 70, 75, 200, 205, 215, 400, 420, 900]  # one out of order; 215 within the hour of 205
    rows = [(i, day + dt.timedelta(minutes=m), 7, "view", 0.1 * i, '{"k": 1}') for i, m in enumerate(mins)]
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.createDataFrame(rows, cols).coalesce(1).write.parquet(f"{one}/events.parquet")
    _one_by_one(spark, rows, cols, f"{many}/events.parquet")
    flows = {
        "x1": lambda s, n: live.run_upserts(live.stream_counts(s), n, ["window_start", "event_type"]),
        "x3": lambda s, n: live.run_append(live.stream_sessions(s), n),
        "x4": lambda s, n: live.run_append(live.stream_dedup(s), n),
        "x6": lambda s, n: live.run_upserts(live.stream_profile(s), n, ["user_id"]),
    }
    for name, flow in flows.items():
        got = [sorted(map(tuple, flow(live.event_stream(spark, d, per), f"{name}{i}").collect()))
               for i, (d, per) in enumerate([(one, None), (many, None), (many, 1)])]
        assert got[0] and got[0] == got[1] == got[2], name
    sessions = live.run_append(live.stream_sessions(live.event_stream(spark, many, 1)), "s").collect()
    assert sorted(r.events for r in sessions) == [2, 2, 3, 3]  # 10:20 and then 10:15 are one session; 900 is still open
    kept = live.run_append(live.stream_dedup(live.event_stream(spark, many, 1)), "d").collect()
    assert sorted(r.event_id for r in kept) == [0, 5, 8]


@pytest.mark.parametrize("idle_days, left", [(90, 40), (3, 1)])
def test_profile_state_falls_when_users_are_idle(spark, tmp_path, idle_days, left):
    """X6 run twice on one checkpoint, ten days apart by event time: states of users idle for longer
    than allowed have gone after the second run, all others stay."""
    folder, seen = f"{tmp_path}/events.parquet", []

    def add(users, day):
        rows = [(u, dt.datetime(2024, 1, day), u, "view", 1.0, '{"k": 1}') for u in users]
        spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                                    "props string").coalesce(1).write.mode("append").parquet(folder)

    def run():
        rows = live.stream_profile(live.event_stream(spark, str(tmp_path)), idle_days)
        writer = (rows.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/checkpoint")
                  .foreachBatch(lambda batch, _: seen.append({r.user_id: r.events for r in batch.collect()})).trigger(availableNow=True))
        query = live._start(writer, spark, 2)
        assert query.awaitTermination(120)
        return query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    add(range(40), 1)
    assert run() == 40
    add([1], 11)
    assert run() == left
    assert seen[0] == {u: 1 for u in range(40)} and [b for b in seen[1:] if b] == [{1: 2}]
