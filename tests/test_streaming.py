import datetime as dt
import json
import os
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import Window, functions as F

from tests.conftest import SMALL
from tidemark.catalog import alerts, tables as t
from tidemark.plans.batch_baseline import baseline_table
from tidemark.plans.replay import replay_messages
from tidemark.plans.stream_alerts import stream_alerts
from tidemark.sinks.files import write_curated
from tidemark.sinks.messages import publish_json
from tidemark.sources.files import json_events_stream, replay_stream
from tidemark.streaming import alerts as al
from tidemark.streaming import events as ev
from tidemark.streaming.counts import counts_of, observed_events
from tidemark.streaming import panes as pn
from tidemark.streaming.windows import (
    flatten_window, grouped_stats, open_windows, paned_stats, windowed_stats,
)
from tools.check_oracles import compare, connect

WAIT = 300
EVENT = "stationReference string, dateTime string, value double"


def events(rows, *data):
    df = rows(EVENT, *data)
    return df.withColumn("dateTime", F.col("dateTime").cast("timestamp"))


def key_set(df):
    return {tuple(map(str, r)) for r in t.rounded(
        df, "mean_level_window", "std_level_window", "z_score", "std_level_total",
        "mean_level_total", "alert_threshold_very_high").collect()}


def test_events_on_a_window_edge(rows):
    df = events(rows, ("a", "2024-01-01 00:05:00", 1.0))
    got = flatten_window(windowed_stats(df)).orderBy("window_start")
    minutes = [(r.window_start.minute, r.window_end.minute) for r in got.collect()]
    assert minutes == [(0, 10), (5, 15)]


def test_events_without_value_are_counted_but_not_averaged(rows):
    df = events(rows, ("a", "2024-01-01 00:01:00", None), ("a", "2024-01-01 00:02:00", 4.0))
    for r in windowed_stats(df).collect():
        assert (r.n_readings_window, r.mean_level_window) == (2, 4.0)


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 200_000), min_size=1, max_size=40),
       st.sampled_from([(10, 5), (60, 15), (30, 30)]))
def test_every_event_lies_in_size_by_slide_windows(rows, seconds, geometry):
    size, slide = geometry
    start = dt.datetime(2024, 1, 1)
    df = events(rows, *(("a", str(start + dt.timedelta(seconds=s)), 1.0) for s in seconds))
    windows = windowed_stats(df, f"{size} minutes", f"{slide} minutes")
    total = windows.agg(F.sum("n_readings_window")).first()[0]
    assert total == len(seconds) * size // slide


def test_event_contract_round_trip(rows):
    df = events(rows, ("a", "2024-01-01 00:00:00.123456", 1.5), ("b", None, None))
    messages = ev.encode_events(df)
    assert messages.dtypes == [("value", "binary")]
    parsed = ev.parse_events(messages).select("stationReference", "dateTime", "value")
    assert parsed.collect() == df.collect()
    assert [r.stationReference for r in ev.valid_events(parsed).collect()] == ["a"]


def test_unreadable_messages_are_filtered(rows):
    df = rows("value string", ("garbage",), ("{}",), (None,),
              ('{"stationReference":"a","dateTime":"2024-01-01T00:00:00Z","value":"1.5"}',))
    assert ev.valid_events(ev.parse_events(df)).count() <= 1


def archive_row(**values):
    names = ["dateTime", "date", "measure", "value", "parameter", "stationReference", "label",
             "unitName", "valueType", "datumType"]
    return tuple(values.get(n) for n in names)


def test_shaped_archive_rows_decode_as_events(rows):
    schema = ("dateTime string, date string, measure string, value string, parameter string, "
              "stationReference string, label string, unitName string, valueType string, "
              "datumType string")
    good = dict(dateTime="2025-11-13T00:00:00Z", stationReference="1A", label="Gauge")
    df = rows(schema, archive_row(**good, value="1.25", parameter="level"),
              archive_row(**good, value="3.488|3.486", parameter="level"),
              archive_row(**good, value="nan", parameter="level"),
              archive_row(**good, value="2", parameter="flow"),
              archive_row(**good, value="2"))
    got = ev.parse_events(ev.encode_events(ev.archive_events(df))).collect()
    assert len(got) == 1
    assert (got[0].dateTime, got[0].value, got[0].stationName) == (
        dt.datetime(2025, 11, 13), 1.25, "Gauge")
    assert got[0].riverName is None


def test_grading_of_special_stations(rows):
    baseline = rows(
        "stationReference string, mean_level_total double, std_level_total double, "
        "alert_threshold_high double, alert_threshold_very_high double, riverName string, "
        "catchmentName string, town string",
        ("flat", 2.0, 0.0, 2.0, 2.0, "r", "c", "t"),
        ("single", 2.0, None, 2.0, None, "r", "c", "t"),
        ("odd", 2.0, 1.0, 9.0, 4.0, "r", "c", "t"), ("odd", 2.0, 1.0, 9.0, 4.0, "r", "c", "t"))
    at = "2024-01-01 00:01:00"
    df = events(rows, ("flat", at, 3.0), ("single", at, 3.0), ("odd", at, 5.0), ("new", at, 9.0))
    graded = al.grade_windows(windowed_stats(df, "10 minutes", "10 minutes"), baseline).collect()
    got = {r.stationReference: (r.z_score, r.alert_level) for r in graded}
    assert len(graded) == 4, "a duplicate baseline row does not fan out"
    assert got == {"flat": (None, "RED"), "single": (None, "AMBER"), "odd": (3.0, "RED"),
                   "new": (None, "NORMAL")}
    unknown = al.grade_windows(windowed_stats(df, "10 minutes", "10 minutes"), baseline, "NONE")
    assert {r.stationReference for r in unknown.where("alert_level = 'NONE'").collect()} == {"new"}


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Five time-ordered message files, oldest modified first, and a baseline."""
    root = tmp_path_factory.mktemp("feed")
    readings = t.readings(spark, SMALL)
    write_curated(baseline_table(readings, t.stations(spark, SMALL)), str(root / "baseline"))
    (root / "topic").mkdir()
    messages = (
        readings.withColumn("part", F.ntile(5).over(Window.orderBy("dateTime")))
        .select("part", F.to_json(F.struct("stationReference", "dateTime", "value"),
                                  ev.JSON_OPTIONS).alias("value"))
    ).collect()
    for part in range(1, 6):
        path = root / "topic" / f"part-{part}.json"
        path.write_text("".join(m.value + "\n" for m in messages if m.part == part))
        os.utime(path, (1_700_000_000 + part * 60,) * 2)
    return root


def closed_windows(spark):
    """What the stream must emit: batch windows that end before the watermark."""
    readings = t.readings(spark, SMALL)
    limit = readings.agg(F.max("dateTime") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    baseline = baseline_table(readings, t.stations(spark, SMALL))
    return al.grade_windows(windowed_stats(readings), baseline).where(
        F.col("window_end") <= F.lit(limit))


def stream(spark, feed, out, max_files=None, **options):
    messages = json_events_stream(spark, str(feed / "topic"), max_files)
    query = stream_alerts(spark, messages, str(feed / "baseline"), f"{out}/alerts",
                          f"{out}/checkpoint", interval=None, **options)
    al.run(query, WAIT)
    return spark.read.parquet(f"{out}/alerts")


@pytest.mark.parametrize("max_files", [None, 1])
def test_stream_equals_batch(spark, feed, tmp_path, max_files):
    got = stream(spark, feed, tmp_path, max_files)
    want = key_set(closed_windows(spark))
    assert key_set(got) == want and got.count() == len(want)
    # A restart from the checkpoint finds nothing new.
    assert stream(spark, feed, tmp_path, max_files).count() == len(want)


@pytest.mark.parametrize("refresh", [False, True])
def test_an_interrupted_stream_resumes_without_loss_or_repeats(spark, feed, tmp_path, refresh):
    messages = json_events_stream(spark, str(feed / "topic"), max_files=1)
    query = stream_alerts(spark, messages, str(feed / "baseline"), f"{tmp_path}/alerts",
                          f"{tmp_path}/checkpoint", interval="0 seconds", refresh=refresh)
    deadline = time.monotonic() + WAIT
    while (query.lastProgress is None or query.lastProgress.batchId < 1) and query.isActive:
        assert time.monotonic() < deadline
        time.sleep(0.05)
    query.stop()
    got = stream(spark, feed, tmp_path, max_files=1, refresh=refresh)
    want = key_set(closed_windows(spark))
    assert got.count() == len(want) and key_set(got.drop("batch_id")) == want


def test_state_is_kept_in_rocksdb(spark, feed, tmp_path):
    messages = json_events_stream(spark, str(feed / "topic"))
    query = stream_alerts(spark, messages, str(feed / "baseline"), f"{tmp_path}/alerts",
                          f"{tmp_path}/checkpoint", interval=None)
    al.run(query, WAIT)
    metrics = query.recentProgress[0].stateOperators[0].customMetrics
    assert any(name.startswith("rocksdb") for name in metrics)


@pytest.mark.parametrize("refresh", [False, True])
def test_micro_batches_can_be_packed_into_few_files(spark, feed, tmp_path, refresh):
    got = stream(spark, feed, tmp_path, files=1, refresh=refresh)
    assert key_set(got.drop("batch_id")) == key_set(closed_windows(spark))
    batches = got.select("_metadata.file_path").distinct().count()
    assert batches == 1, "all windows close in one micro-batch here"


def test_refreshing_stream_equals_batch_and_repeats_batches_in_place(spark, feed, tmp_path):
    got = stream(spark, feed, tmp_path, 1, refresh=True)
    want = key_set(closed_windows(spark))
    assert key_set(got.drop("batch_id")) == want
    write = al.baseline_writer(str(feed / "baseline"), str(tmp_path / "again"))
    windows = windowed_stats(t.readings(spark, SMALL))
    for _ in range(2):
        write(windows, 7)
    assert spark.read.parquet(str(tmp_path / "again")).count() == windows.count()


def test_refreshing_stream_sees_an_overwritten_baseline(spark, rows, tmp_path):
    baseline, topic = str(tmp_path / "baseline"), str(tmp_path / "topic")
    base = ("stationReference string, mean_level_total double, std_level_total double, "
            "alert_threshold_high double, alert_threshold_very_high double, riverName string, "
            "catchmentName string, town string")
    for hour, very_high in ((0, 100.0), (5, 1.0)):
        write_curated(rows(base, ("a", 1.0, 1.0, very_high, very_high, "r", "c", "t")), baseline)
        publish_json(ev.encode_events(events(
            rows, ("a", f"2024-01-01 0{hour}:02:00", 50.0), ("z", f"2024-01-01 0{hour}:59:00", 0.0)
        )), topic)
        windows = windowed_stats(ev.valid_events(ev.parse_events(json_events_stream(spark, topic))))
        al.run(al.start_alerts_refreshing(windows, baseline, str(tmp_path / "out"),
                                          str(tmp_path / "checkpoint"), interval=None), WAIT)
    got = spark.read.parquet(str(tmp_path / "out")).where("stationReference = 'a'")
    by_hour = {(r.window_start.hour, r.alert_level) for r in got.collect()
               if r.window_start.minute == 0}
    assert by_hour == {(0, "NORMAL"), (5, "RED")}


def test_latest_file_first_loses_late_windows(spark, feed, tmp_path):
    folder = tmp_path / "archive"
    folder.mkdir()
    header = "dateTime,value,parameter,stationReference\n"
    for part in range(1, 6):
        lines = [
            f"{r.dateTime:%Y-%m-%dT%H:%M:%S.%fZ},{r.value},level,{r.stationReference}\n"
            for r in ev.parse_events(spark.read.text(str(feed / "topic" / f"part-{part}.json")))
            .collect()
        ]
        path = folder / f"readings-full-2024-01-0{part}.csv"
        path.write_text(header + "".join(lines))
        os.utime(path, (1_700_000_000 + part * 60,) * 2)
    counts = {}
    for latest in (False, True):
        rows = replay_stream(spark, str(folder), latest_first=latest, max_files=1)
        parsed = ev.parse_events(ev.encode_events(ev.archive_events(rows)))
        windows = flatten_window(windowed_stats(ev.valid_events(parsed)))
        out = tmp_path / f"out-{latest}"
        query = al.run(al.start_alerts(windows, f"{out}/w", f"{out}/c", interval=None), WAIT)
        counts[latest] = spark.read.parquet(f"{out}/w").count()
        assert (al.late_rows(query) > 0) == latest
    assert counts[False] == closed_windows(spark).count()
    assert counts[True] < counts[False]


def test_late_rows_of_a_long_stream(spark, tmp_path):
    """More micro-batches than Spark keeps the progress of; the late ones are the first."""
    folder = tmp_path / "topic"
    folder.mkdir()
    times = ["2024-01-02T00:00:00Z", *["2024-01-01T00:00:00Z"] * 3, *["2024-01-02T00:01:00Z"] * 110]
    for part, time_ in enumerate(times):
        path = folder / f"part-{part:03}.json"
        path.write_text(f'{{"stationReference":"a","dateTime":"{time_}","value":"1.5"}}\n')
        os.utime(path, (1_700_000_000 + part * 60,) * 2)

    parsed = ev.parse_events(json_events_stream(spark, str(folder), 1))
    windows = flatten_window(windowed_stats(ev.valid_events(parsed)))
    query = al.run(al.start_alerts(windows, f"{tmp_path}/w", f"{tmp_path}/c", interval=None), WAIT)
    kept = query.recentProgress
    assert kept[-1].batchId >= 110 and not any(s.numRowsDroppedByWatermark for p in kept for s in p.stateOperators)
    emitted = spark.read.parquet(f"{tmp_path}/w").where("window_start < '2024-01-01 12:00:00'")
    n = emitted.agg(F.coalesce(F.sum("n_readings_window"), F.lit(0))).first()[0]
    assert al.late_rows(query) == al.late_rows(query) == 3 * 2 - n > 0  # a reading lies in two windows
    counts = counts_of(query)
    assert counts["n_batches"] >= 114 and counts["n_rows"] == 114


def minutes(spark, folder, n, late=()):
    """A file for each of ``n`` readings, one a minute; modification times in that order."""
    folder.mkdir()
    for part, minute in enumerate([*range(n), *late]):
        path = folder / f"part-{part:03}.json"
        path.write_text(f'{{"stationReference":"a","dateTime":"2024-01-01T{minute // 60:02}:'
                        f'{minute % 60:02}:00Z","value":{minute * 1.25}}}\n')
        os.utime(path, (1_700_000_000 + part * 60,) * 2)
    return ev.valid_events(ev.parse_events(json_events_stream(spark, str(folder), 1)))


def as_rows(windows):
    flat = windows if "window_start" in windows.columns else flatten_window(windows)
    return sorted((r.stationReference, str(r.window_start), str(r.window_end), r.n_readings_window,
                   r.mean_level_window and round(r.mean_level_window, 9),
                   r.std_level_window and round(r.std_level_window, 9)) for r in flat.collect())


def test_panes_give_the_same_windows_with_fewer_updates(spark, tmp_path):
    updates = {}
    for name, form in (("direct", windowed_stats), ("panes", paned_stats)):
        stream = minutes(spark, tmp_path / f"in-{name}", 60, late=[3, 59])
        windows = flatten_window(form(stream, "30 minutes", "5 minutes"))
        query = al.run(al.start_alerts(
            windows, f"{tmp_path}/{name}", f"{tmp_path}/c-{name}", interval=None), WAIT)
        counts = counts_of(query)
        updates[name] = counts["n_updated"]
        assert counts["n_late"] > 0
    got = [as_rows(spark.read.parquet(f"{tmp_path}/{name}")) for name in updates]
    assert got[0] == got[1] and len(got[0]) > 5
    assert updates["panes"] * 2 < updates["direct"]


def lines(folder, part, *data):
    """A file of readings (station, time of day, value); modification times by ``part``."""
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{part:03}.json"
    path.write_text("".join(
        json.dumps({"stationReference": s, "dateTime": f"2024-01-01T{at}Z", "value": v}) + "\n"
        for s, at, v in data))
    os.utime(path, (1_700_000_000 + part * 60,) * 2)


def test_panes_write_no_state_row_for_each_window(spark, tmp_path):
    """Fifty windows over each of many panes: state is written for panes and groups of stations."""
    stations = [f"s{i}" for i in range(600)]
    for part in range(3):
        lines(tmp_path / "in", part, *((s, f"{part * 6:02}:02:00", 1.5) for s in stations))
    stream = ev.valid_events(ev.parse_events(json_events_stream(spark, str(tmp_path / "in"), 1)))
    query = al.run(al.start_alerts(flatten_window(paned_stats(stream, "250 minutes", "5 minutes")),
                                   f"{tmp_path}/out", f"{tmp_path}/c", interval=None), WAIT)
    assert counts_of(query)["n_updated"] < 5 * 3 * len(stations)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.distinct().count() == 600 * 50 * 2


def test_panes_close_windows_of_silent_stations_and_after_restarts(spark, tmp_path):
    """Stations without new readings, values missing, far from zero or seen once; each file is
    a run of its own."""
    got, direct = [], []
    parts = [
        [("a", "00:01:00", 1e9), ("a", "00:07:00", 1e9 + 0.5), ("b", "00:02:00", None)],
        [("c", "00:31:00", 4.0), ("a", "00:22:00", 1e9 + 1), ("c", "00:33:30", None)],
        [("d", "01:20:00", 1.0)], [("a", "03:00:00", 2.0), ("d", "02:59:00", 3.0)],
        [("e", "09:00:00", 0.0)],
    ]
    for part, data in enumerate(parts):
        lines(tmp_path / "in", part, *data)
        for form, all_of in ((paned_stats, got), (windowed_stats, direct)):
            stream = ev.valid_events(ev.parse_events(json_events_stream(spark, str(tmp_path / "in"))))
            name = form.__name__
            al.run(al.start_alerts(flatten_window(form(stream, "30 minutes", "5 minutes")),
                                   f"{tmp_path}/{name}", f"{tmp_path}/c-{name}", interval=None), WAIT)
            all_of.append(as_rows(spark.read.parquet(f"{tmp_path}/{name}")))
    assert got == direct and [len(g) for g in got] == sorted(len(g) for g in got) and len(got[-1]) > 30


def test_panes_of_a_table_equal_windows(rows):
    data = [(s, f"2024-01-01 0{h}:{m:02}:00", v) for s in "ab" for h in range(3)
            for m, v in ((0, 1e9 + h), (5, None), (7, 1e9 + 0.5), (59, float(h)))]
    table = events(rows, *data, ("c", "2024-01-01 00:00:00", None))
    for size, slide in (("1 hour", "5 minutes"), ("10 minutes", "5 minutes"), ("5 minutes", "5 minutes")):
        assert as_rows(paned_stats(table, size, slide)) == as_rows(windowed_stats(table, size, slide))


BASE = ("stationReference string, mean_level_total double, std_level_total double, "
        "alert_threshold_high double, alert_threshold_very_high double, riverName string, "
        "catchmentName string, town string")


@pytest.mark.parametrize("refresh", [False, True])
def test_alerts_write_no_state_row_for_each_window(spark, rows, tmp_path, refresh):
    write_curated(rows(BASE, ("s1", 1.0, 1.0, 1.0, 9.0, "r", "c", "t")), f"{tmp_path}/baseline")
    for part in range(2):
        lines(tmp_path / "in", part, *(
            (f"s{i}", f"{part * 6:02}:{m:02}:00", 1.5) for i in range(600) for m in (2, 12, 22)))
    query = stream_alerts(
        spark, json_events_stream(spark, str(tmp_path / "in"), 1), f"{tmp_path}/baseline",
        f"{tmp_path}/out", f"{tmp_path}/c", interval=None, refresh=refresh)
    counts = counts_of(al.run(query, WAIT))
    assert 0 < counts["n_updated"] <= pn.GROUPS * counts["n_batches"] and counts["n_rows"] == 3600
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.distinct().count() == 600 * 8
    assert {tuple(r) for r in out.select("stationReference", "alert_level").distinct().collect()
            if r.alert_level != "NORMAL"} == {("s1", "AMBER")}


@pytest.mark.parametrize("size, slide", [("10 minutes", "5 minutes"), ("7 minutes", "3 minutes")])
def test_groups_give_the_windows_of_the_direct_form(spark, tmp_path, size, slide):
    """Late readings, of old and new stations and with some of their windows still open; silent
    stations, missing values, windows over several micro-batches and a restart."""
    parts = [
        [("a", "00:01:00", 1e9), ("a", "00:07:00", 1e9 + 0.5), ("b", "00:02:00", None)],
        [("a", "00:08:00", 1e9 + 1), ("c", "00:08:00.5", 4.0), ("c", "00:09:30", None)],
        [("d", "01:21:00", 1.0)],
        [("d", "01:20:30", 2.5)],
        [("a", "01:06:30", 2.0), ("e", "01:07:00", 3.0), ("f", "01:02:00", 5.0), ("d", "01:12:00", 0.1)],
        [("d", "01:21:30", 7.0), ("g", "00:05:00", 3.0), ("g", "01:09:00", None)],
        [("h", "09:00:00", 0.0)],
    ]
    late = {}
    for form in (grouped_stats, windowed_stats):
        name = form.__name__
        for first, run in ((0, parts[:5]), (5, parts[5:])):
            for part, data in enumerate(run, first):
                lines(tmp_path / f"in-{name}", part, *data)
            stream = ev.valid_events(ev.parse_events(json_events_stream(spark, f"{tmp_path}/in-{name}", 1)))
            query = al.run(al.start_alerts(flatten_window(form(stream, size, slide)),
                                           f"{tmp_path}/{name}", f"{tmp_path}/c-{name}", interval=None), WAIT)
            late.setdefault(name, []).append(counts_of(query)["n_late"])
    got, direct = (as_rows(spark.read.parquet(f"{tmp_path}/{name}")) for name in late)
    assert got == direct and len(got) == len(set(got)) > 10
    assert late["grouped_stats"] == late["windowed_stats"] and all(late["grouped_stats"])


def test_a_hot_station_takes_the_room_of_its_windows(monkeypatch):
    monkeypatch.setattr(pn, "AT_ONCE", 100)
    value = np.random.default_rng(0).normal(1e6, 1, 20_000)
    value[::10] = np.nan
    end = np.arange(20_000) % 7 * 300_000_000
    chunks = (pd.DataFrame({"stationReference": "a", "value": value[i:i + 50], "window_end": end[i:i + 50]})
              for i in range(0, 20_000, 50))
    parts = pn.partial_windows(chunks)
    assert sum(map(len, parts)) < 200
    got = pn.merge_windows(parts).sort_values("window_end")
    assert len(got) == 7
    for at, r in zip(sorted(set(end)), got.itertuples()):
        mine = value[end == at]
        known = mine[~np.isnan(mine)]
        assert (r.window_end, r.n, r.c) == (at, len(mine), len(known))
        assert abs(r.mean - known.mean()) < 1e-8 and abs(r.m2 / (r.c - 1) - known.var(ddof=1)) < 1e-8


def test_closed_and_open_windows_are_all_windows(spark, tmp_path):
    for part in range(2):  # also in the middle, and after a restart
        stream = minutes(spark, tmp_path / f"in{part}", 40 + 30 * part)
        al.run(al.start_alerts(flatten_window(windowed_stats(stream)), f"{tmp_path}/out{part}",
                               f"{tmp_path}/c{part}", interval=None), WAIT)
        closed = spark.read.parquet(f"{tmp_path}/out{part}")
        held = flatten_window(open_windows(spark, f"{tmp_path}/c{part}"))
        table = ev.valid_events(ev.parse_events(spark.read.text(f"{tmp_path}/in{part}")))
        assert as_rows(closed.unionByName(held)) == as_rows(windowed_stats(table))
        assert held.count() >= 4


def test_counts_under_an_interval(spark, tmp_path):
    """More than a hundred micro-batches of a stream that goes on; the counts end with it."""
    folder = tmp_path / "in"
    minutes(spark, folder, 110)
    (folder / "zz.json").write_text('no json\n{"stationReference":"a"}\n')
    stream = ev.valid_events(observed_events(ev.parse_events(json_events_stream(spark, str(folder), 1))))
    query = al.start_alerts(stream, f"{tmp_path}/out", f"{tmp_path}/c", interval="0 seconds")
    assert counts_of(query)["n_messages"] <= 112
    al.run_to_end(query)
    counts = counts_of(query)
    assert (counts["n_messages"], counts["n_rejected"], counts["n_rows"]) == (112, 2, 112)
    assert counts["n_batches"] > 100 and query.counting is None
    assert spark.read.parquet(f"{tmp_path}/out").count() == 110


def test_parts_are_published_by_several_tasks_in_the_order_of_time(spark, monkeypatch):
    monkeypatch.setattr(alerts, "FILE_ROWS", 50)
    root = alerts.prepare_stream(spark, SMALL)
    topic = spark.read.text(f"{root}/topic")
    n_files = len(topic.inputFiles())
    assert n_files > alerts.PARTS and n_files % alerts.PARTS == 0
    at = F.from_json("value", EVENT)["dateTime"]
    files = topic.groupBy(F.col("_metadata.file_modification_time").alias("written"),
                          F.input_file_name().alias("file")).agg(F.min(at), F.max(at))
    found = sorted(tuple(r) for r in files.collect())
    each = n_files // alerts.PARTS
    ends = [(min(f[2] for f in found[i:i + each]), max(f[3] for f in found[i:i + each]))
            for i in range(0, n_files, each)]
    assert len(found) == n_files and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert compare(spark, connect(SMALL), "alerts_stream", SMALL) == ""


@pytest.mark.parametrize("times", [[], [None], ["2024-01-01 00:00:00"] * 7, ["2024-01-01 00:00:00", None, "2024-01-03 00:00:00"]])
def test_parts_of_few_readings(spark, rows, tmp_path, times):
    for name in ("customer", "nation", "region"):
        os.symlink(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    data = [(i, time_, i % 2, 1.5 * i, "view") for i, time_ in enumerate(times)]
    table = rows("event_id long, ts string, user_id long, value double, event_type string", *data)
    table.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    root = alerts.prepare_stream(spark, str(tmp_path))
    assert alerts.run_stream(spark, root).count() == (2 if times[-1:] == ["2024-01-03 00:00:00"] else 0)


def test_run_reports_a_stream_that_does_not_end(spark, feed, tmp_path):
    messages = json_events_stream(spark, str(feed / "topic"))
    query = al.start_alerts(messages, str(tmp_path / "o"), str(tmp_path / "c"), "1 second")
    with pytest.raises(TimeoutError):
        al.run(query, 2)
    assert not query.isActive


def test_stream_joins_the_baseline_as_read(spark, feed, tmp_path):
    """The plan of a micro-batch: the baseline is neither deduplicated nor shuffled, and three
    fields are parsed."""
    query = stream_alerts(spark, json_events_stream(spark, str(feed / "topic")),
                          str(feed / "baseline"), str(tmp_path / "out"), str(tmp_path / "c"),
                          interval=None)
    al.run(query, WAIT)
    plan = query._jsq.explainInternal(False)
    assert "BroadcastHashJoin" in plan and "row_number" not in plan
    assert "CartesianProduct" not in plan and "catchmentName,StringType" not in plan


def test_grading_fails_while_the_baseline_is_missing(rows, tmp_path):
    (tmp_path / "baseline").mkdir()
    windows = windowed_stats(events(rows, ("a", "2024-01-01 00:01:00", 1.0)))
    with pytest.raises(AnalysisException):
        al.baseline_writer(str(tmp_path / "baseline"), str(tmp_path / "out"))(windows, 0)


def test_replay_of_an_empty_folder(spark, tmp_path):
    assert replay_messages(spark, str(tmp_path)).count() == 0
