import os

import pytest
from pyspark.sql import SparkSession, functions as F

from tidemark import schemas
from tidemark.operators.calendar import (
    date_spine, flag_in_interval, interval_days, station_day_spine,
)
from tidemark.sinks import versions
from tidemark.plans import (
    batch_baseline, load_warehouse, replay, station_summary, stream_alerts,
)
from tidemark.sinks.files import write_csv
from tidemark.sources.files import read_csv


@pytest.fixture
def keep_session(monkeypatch):
    """Let a command run on the test session without stopping it."""
    monkeypatch.setattr(SparkSession, "stop", lambda self: None)


@pytest.fixture
def raw_zone(tmp_path):
    archive, stations = tmp_path / "archive", tmp_path / "stations"
    archive.mkdir(), stations.mkdir()
    for day in (1, 2):
        lines = ["dateTime,date,measure,value,parameter,stationReference,label"]
        for minute in range(0, 60, 5):
            at = f"2024-01-0{day}T00:{minute:02d}:00Z"
            lines.append(f"{at},2024-01-0{day},/id/measures/1A-l,{minute}.5|1,level,1A,Ay")
            lines.append(f"{at},2024-01-0{day},/id/measures/2B-l,{minute},level,2B,Bee")
            lines.append(f"{at},2024-01-0{day},/id/measures/2B-f,999,flow,2B,Bee")
        (archive / f"readings-full-2024-01-0{day}.csv").write_text("\n".join(lines) + "\n")
    (stations / "s.csv").write_text(
        "stationReference,label,riverName,catchmentName,town,lat,long,status\n"
        "1A,Ay,R,C,T,51.0,-1.0,active\n1A,Zed,R,C,T,51.0,-1.0,active\n")
    return tmp_path


def test_jobs_end_to_end_from_the_command_line(spark, raw_zone, keep_session):
    root = str(raw_zone)
    batch_baseline.main(["--readings", f"{root}/archive", "--stations", f"{root}/stations",
                         "--out", f"{root}/curated", "--parameter", "level", "--min-max"])
    baseline = {r.stationReference: r for r in
                spark.read.parquet(f"{root}/curated/{batch_baseline.BASELINE}").collect()}
    assert set(baseline) == {"1A", "2B"}
    assert (baseline["1A"].n_readings_total, baseline["1A"].label) == (24, "Ay")
    assert (baseline["2B"].max_level, baseline["2B"].label) == (55.0, None)
    assert baseline["2B"].alert_threshold_high == baseline["2B"].p95_level == 55.0
    daily = spark.read.parquet(f"{root}/curated/{batch_baseline.DAILY}")
    assert daily.count() == 4 and daily.agg(F.sum("n_readings_day")).first()[0] == 48

    replay.main(["--archive", f"{root}/archive", "--json", f"{root}/topic"])
    assert spark.read.text(f"{root}/topic").count() == 24, "piped values are not strict numbers"

    stream_alerts.main(["--json", f"{root}/topic", "--baseline",
                        f"{root}/curated/{batch_baseline.BASELINE}", "--out", f"{root}/alerts",
                        "--checkpoint", f"{root}/checkpoint", "--once"])
    alerts = spark.read.parquet(f"{root}/alerts")
    assert alerts.columns == schemas.ALERT_COLUMNS
    assert {r.stationReference for r in alerts.collect()} == {"2B"}


def test_batch_job_without_parameter_keeps_all(spark, raw_zone):
    root = str(raw_zone)
    paths = batch_baseline.batch_baseline(
        spark, f"{root}/archive", f"{root}/stations", f"{root}/all", exact=True)
    rows = spark.read.parquet(paths[batch_baseline.BASELINE])
    assert {r.stationReference: r.n_readings_total for r in rows.collect()} == {"1A": 24, "2B": 48}


def test_load_job(spark, raw_zone, keep_session):
    root = str(raw_zone)
    batch_baseline.batch_baseline(spark, f"{root}/archive", f"{root}/stations", f"{root}/curated")
    for _ in range(2):  # a second load replaces the first
        load_warehouse.main(["--curated", f"{root}/curated", "--prefix", "loaded_",
                             "--location", f"{root}/warehouse"])
    assert spark.table("loaded_batch_station_daily").count() == 4
    assert spark.table("loaded_batch_station_baseline").count() == 2
    for name in ("daily", "baseline"):
        spark.sql(f"DROP TABLE loaded_batch_station_{name}")


def test_batch_job_of_an_empty_folder(spark, raw_zone, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    args = spark, str(empty), f"{raw_zone}/stations", f"{tmp_path}/none", "level"
    with pytest.raises(ValueError, match="no CSV file"):
        batch_baseline.batch_baseline(*args)
    assert not (tmp_path / "none").exists()
    paths = batch_baseline.batch_baseline(*args, allow_empty=True)
    assert spark.read.parquet(paths[batch_baseline.BASELINE]).count() == 0


def test_batch_job_stops_on_a_header_without_values(spark, raw_zone, tmp_path):
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "a.csv").write_text("dateTime,measure,parameter\nt,m,level\n")
    with pytest.raises(ValueError, match="no column value"):
        batch_baseline.batch_baseline(
            spark, f"{tmp_path}/odd", f"{raw_zone}/stations", f"{tmp_path}/none", "level")


def test_baseline_replaced_at_once_and_merged_from_states(spark, raw_zone, tmp_path):
    args = (spark, f"{raw_zone}/archive", f"{raw_zone}/stations")
    plain = batch_baseline.batch_baseline(*args, f"{tmp_path}/a", "level")
    found = batch_baseline.batch_baseline(*args, f"{tmp_path}/b", "level", exact=False, at_once=True)
    baselines = [spark.read.parquet(plain["batch_station_baseline"]),
                 versions.read_table(spark, found["batch_station_baseline"])]
    assert baselines[0].columns == baselines[1].columns
    rows = [sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in b.collect())
            for b in baselines]
    assert rows[0] == rows[1] and len(rows[0]) > 0
    daily = [spark.read.parquet(p["batch_station_daily"]) for p in (plain, found)]
    assert daily[0].columns == daily[1].columns and daily[0].count() == daily[1].count()
    again = batch_baseline.batch_baseline(*args, f"{tmp_path}/b", "level", at_once=True)
    assert versions.read_either(spark, again["batch_station_baseline"]).count() == len(rows[0])
    assert baselines[1].count() == len(rows[0])  # a reader goes on with what it found


def test_replay_goes_by_the_name_and_counts(spark, raw_zone):
    newest = raw_zone / "archive" / "readings-full-2024-01-02.csv"
    os.utime(newest, (1_600_000_000,) * 2)  # older than the other one
    published = []
    sent = replay.replay_in_order(
        spark, f"{raw_zone}/archive",
        lambda df: published.append([r.value.decode() for r in df.collect()]))
    assert [path.rsplit("-", 1)[1] for path, _ in sent] == ["01.csv", "02.csv"]
    assert [n for _, n in sent] == [12, 12] == [len(p) for p in published]
    assert all("2024-01-01" in m for m in published[0])


def test_replay_of_several_files_in_one_job(spark, raw_zone):
    published = []
    sent = replay.replay_in_order(
        spark, f"{raw_zone}/archive", lambda df: published.append(df.collect()), newest_first=True,
        files_per_job=5)
    assert [(path.rsplit("-", 1)[1], n) for path, n in sent] == [("02.csv", 12), ("01.csv", 12)]
    (rows,) = published
    assert {(r.position, b"2024-01-02" in bytes(r.value)) for r in rows} == {(1, True), (2, False)}


def test_commands_check_their_arguments():
    for command, argv in ((replay.main, ["--archive", "a"]),
                          (stream_alerts.main, ["--servers", "h", "--baseline", "b", "--out", "o",
                                                "--checkpoint", "c"])):
        with pytest.raises(SystemExit):
            command(argv)


def test_station_summary_command(spark, rows, tmp_path, keep_session):
    daily = rows("stationReference string, date string, level double, typical_range_low double, "
                 "typical_range_high double, flood_risk string",
                 ("a", "2024-01-01", 1.0, 0.0, 1.0, "Low"),
                 ("a", "2024-01-02", 2.0, 0.0, 1.0, "High"),
                 ("a", "2024-01-03", 2.0, 0.0, 1.0, "High"),
                 ("nometa", "2024-01-03", 2.0, 0.0, 1.0, "High"))
    meta = rows("stationReference string, stationName string, base_level double", ("a", "A", 1.0),
                ("nodata", "N", 2.0))
    write_csv(daily, f"{tmp_path}/daily")
    write_csv(meta, f"{tmp_path}/stations")
    station_summary.main(["--daily", f"{tmp_path}/daily", "--stations", f"{tmp_path}/stations",
                          "--out", f"{tmp_path}/summary"])
    got = spark.read.option("header", True).csv(f"{tmp_path}/summary").collect()
    assert len(got) == 1
    row = got[0].asDict()
    assert (row["mean_level_total"], row["p05_level"], row["dominant_risk"]) == (
        "1.667", "1.1", "High")
    assert "base_level" not in row


def test_expected_daily_lifts_event_days(spark, rows):
    stations = rows(
        "stationReference string, base_level double, typical_range_low double, "
        "typical_range_high double, alert_threshold_high double, "
        "alert_threshold_very_high double", ("a", 1.0, 0.5, 1.5, 1.8, 2.0))
    means = rows("date string, season double", ("2024-01-01", 9.0), ("2024-01-02", 2.25),
                 ("2024-01-03", 0.5)).withColumn("date", F.to_date("date"))
    intervals = rows("stationReference string, start string, length int",
                     ("a", "2024-01-02", 2), ("a", "2024-01-03", 1), ("b", "2024-01-01", 9)
                     ).withColumn("start", F.to_date("start"))
    daily = station_summary.expected_daily(stations, intervals, means, "2024-01-01", 4).orderBy("date")
    assert daily.columns == schemas.DAILY_RISK.names
    assert [(r.level, r.flood_risk) for r in daily.collect()] == [
        (1.0, "Low"), (2.25, "Very high"), (1.0, "Low"), (1.0, "Low")]


def test_intervals_count_once_and_may_be_empty(rows):
    intervals = rows("stationReference string, start string, length int",
                     ("a", "2024-01-01", 2), ("a", "2024-01-02", 2), ("a", "2024-01-09", 0),
                     (None, "2024-01-01", 1)).withColumn("start", F.to_date("start"))
    days = rows("stationReference string, date string", ("a", "2024-01-02"), ("a", "2024-01-04"),
                ("a", "2024-01-02"), ("b", "2024-01-02"), (None, "2024-01-01"))
    days = days.withColumn("date", F.to_date("date"))
    assert interval_days(intervals).where("stationReference = 'a'").count() == 3
    flags = [r.in_interval for r in
             flag_in_interval(days, intervals).orderBy("stationReference", "date").collect()]
    assert flags == [False, True, True, False, False]


def test_spine(spark, rows):
    last = date_spine(spark, "2024-02-28", 3).agg(F.max("date")).first()[0]
    assert last.isoformat() == "2024-03-01"
    spine = station_day_spine(rows("stationReference string", ("a",), ("b",)), "2024-01-01", 31, 3)
    assert spine.distinct().count() == 62 and spine.rdd.getNumPartitions() == 3


def test_metadata_csv_reads_into_the_declared_types(spark, tmp_path):
    (tmp_path / "m.csv").write_text("stationReference,typical_range_high,extra\na,1.5,x\n")
    row = read_csv(spark, str(tmp_path), schemas.STATION_METADATA).first()
    assert row.typical_range_high == 1.5 and row.alert_threshold_high is None
