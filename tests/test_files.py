import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidemark import schemas
from tidemark.session import clear_scratch, scratch_path, store
from tidemark.sinks.files import load_table, write_csv, write_curated
from tidemark.sinks.messages import kafka_sink_options, publish_events, publish_json
from tidemark.sources import files as src
from tidemark.sources.kafka import kafka_events, kafka_source_options

WIDE = ("dateTime,date,measure,qualifier,value,parameter,stationReference,label\n"
        "2024-01-0{d}T00:00:00Z,2024-01-0{d},/id/measures/1A-x,q,{v},level,1A,Gauge\n")


@pytest.fixture
def archive(tmp_path):
    for day, value in ((1, "3.4|3.5"), (2, "2"), (3, "x")):
        text = WIDE.format(d=day, v=value)
        (tmp_path / f"readings-full-2024-01-0{day}.csv").write_text(text)
    (tmp_path / "notes.csv").write_text("a,b\n1,2\n")
    (tmp_path / "readings-full-2024-01-04.txt").write_text("z\n9\n")
    return str(tmp_path)


def test_columns_are_bound_by_header_name(spark, archive):
    rows = src.read_csv(spark, archive, schemas.READINGS, pathGlobFilter="readings-*.csv")
    assert rows.columns == ["dateTime", "measure", "value"]
    assert {r.value for r in rows.collect()} == {"3.4|3.5", "2", "x"}


def test_value_stays_text_when_every_value_is_clean(spark, tmp_path):
    (tmp_path / "a.csv").write_text("dateTime,measure,value\nt,m,0.0001\n")
    assert src.read_readings(spark, str(tmp_path)).first().value == "0.0001"


def test_a_differently_ordered_header_stops_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("dateTime,measure,value\nt,m,1\n")
    (tmp_path / "b.csv").write_text("value,dateTime,measure\n1,t,m\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        src.read_readings(spark, str(tmp_path)).collect()
    both = src.union_by_header(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert {tuple(r) for r in both.select("dateTime", "value").collect()} == {("t", "1")}


def test_archive_selection_order_and_dates(spark, archive):
    rows = src.archive_files(spark, archive)
    assert rows.count() == 3
    newest = src.archive_order(rows, newest_first=True).collect()
    assert [r.file_date for r in newest] == [dt.date(2024, 1, d) for d in (3, 2, 1)]
    assert [r.position for r in newest] == [1, 2, 3]
    assert [r.n_rows for r in src.archive_order(rows).collect()] == [1, 1, 1]
    assert rows.select("unitName").distinct().collect()[0][0] is None


def test_folder_without_archive_files_gives_no_rows(spark, tmp_path):
    rows = src.archive_files(spark, str(tmp_path))
    assert rows.count() == 0
    assert rows.columns == [*schemas.ARCHIVE_ROW.names, "file_path", "file_date"]


def test_stations_are_typed_and_bad_numbers_become_null(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "status,stationReference,lat,long\nactive,1A,51.5,oops\n"
    )
    row = src.read_stations(spark, str(tmp_path)).first()
    assert (row.lat, row.long, row.status, row.town) == (51.5, None, "active", None)


def test_csv_quoting_survives_a_round_trip(spark, rows, tmp_path):
    data = [("1A", 'The "Old" Bridge, north', "a\\b")]
    path = str(tmp_path / "out")
    write_csv(rows("stationReference string, label string, town string", *data), path)
    got = src.read_stations(spark, path).select("stationReference", "label", "town")
    assert [tuple(r) for r in got.collect()] == data


def test_partitioned_csv_reads_back_with_its_folder_column(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    df = rows("stationReference string, label string, town string", ("a", "x", "t"),
              ("b", None, "u"))
    write_csv(df, path, partition_by="town")
    got = src.read_stations(spark, path).select("stationReference", "label", "town")
    assert {tuple(r) for r in got.collect()} == {("a", "x", "t"), ("b", None, "u")}


def test_curated_write_replaces_and_prunes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = rows("stationReference string, reading_date string, value double",
              ("a", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0))
    dated = df.withColumn("reading_date", F.to_date("reading_date"))
    write_curated(dated, path, partition_by="reading_date")
    write_curated(dated, path, partition_by="reading_date")
    table = src.read_baseline(spark, path)
    assert table.count() == 2 and dict(table.dtypes)["reading_date"] == "date"
    plan = plan_of(table.where("reading_date = DATE '2024-01-02' AND value > 1").select("value"))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,1.0)]" in plan
    assert "ReadSchema: struct<value:double>" in plan
    assert "reading_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_load_table_replaces_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(rows("x int", (1,), (2,)), path)
    for _ in range(2):
        table = load_table(spark, path, "station_baseline_test", str(tmp_path / "warehouse"))
    assert table.count() == 2
    spark.sql("DROP TABLE station_baseline_test")


def test_kafka_option_maps():
    assert kafka_source_options("h:9092", "t", max_offsets=500) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
    }
    assert "maxOffsetsPerTrigger" not in kafka_source_options("h:9092", "t", "latest")
    assert kafka_sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(PySparkException, match="(?i)kafka"):
        kafka_events(spark, "localhost:1", "t")


def test_kafka_sink_needs_its_connector(rows):
    with pytest.raises(PySparkException, match="(?i)kafka"):
        publish_events(rows("value binary", (b"{}",)), "localhost:1", "t")


def test_published_json_is_one_message_per_line(spark, rows, tmp_path):
    path = str(tmp_path / "topic")
    publish_json(rows("value binary, n int", (b'{"a":1}', 1)), path)
    publish_json(rows("value binary", (b'{"a":2}',)), path)
    assert {r.value for r in spark.read.text(path).collect()} == {'{"a":1}', '{"a":2}'}


def test_scratch_lies_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/tidemark/")


def test_cleared_scratch_is_gone(spark):
    kept = store(spark.range(3).toDF("x"), "kept")
    folder = os.path.dirname(scratch_path(spark, "x"))
    assert os.path.isdir(folder) and kept.count() == 3
    clear_scratch(spark)
    assert not os.path.exists(folder)


def test_stored_table_does_not_change(spark):
    df = store(spark.range(5).select(F.rand().alias("x")), "x")
    assert df.collect() == df.collect()


class ClusterSession:
    """A session on a cluster master without a shared folder."""
    class sparkContext:
        master = "yarn"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_scratch_refuses_a_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(ClusterSession, "x")


def test_header_case_and_needed_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("VALUE,x,DateTime,Measure\n1,y,t,m\n")
    assert tuple(src.read_readings(spark, str(tmp_path)).first()) == ("t", "m", "1")
    (tmp_path / "a.csv").write_text("dateTime,measure\nt,m\n")
    with pytest.raises(ValueError, match="no column value"):
        src.read_readings(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text("StationReference,Label\ns,l\n")
    assert src.read_stations(spark, str(tmp_path)).first().stationReference == "s"


def test_line_feeds_in_values(spark, rows, tmp_path):
    df = rows("dateTime string, measure string, value string", ("t", "a\nb", "1"), ("u", "c", "2"))
    with pytest.raises(Exception, match="line feed in column measure"):
        write_csv(df, str(tmp_path / "one"))
    write_csv(df, str(tmp_path / "many"), multi_line=True)
    got = src.read_readings(spark, str(tmp_path / "many"), multi_line=True).collect()
    assert sorted(map(tuple, got)) == [("t", "a\nb", "1"), ("u", "c", "2")]


def test_partitioned_write_makes_a_file_a_day(spark, tmp_path):
    df = spark.range(8000).repartition(16).selectExpr("id", "date_add(DATE '2024-01-01', cast(id % 30 AS int)) AS d")
    write_curated(df, str(tmp_path / "t"), partition_by="d")
    files = list((tmp_path / "t").glob("d=*/*.parquet"))
    assert 30 <= len(files) <= 60 and spark.read.parquet(str(tmp_path / "t")).count() == 8000
