import os
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import versions
from tidemark.sinks.files import write_curated
from tidemark.sources.files import json_events_stream
from tidemark.streaming import alerts as al


def test_a_reader_sees_the_old_table_or_the_new_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path)
    versions.replace_table(spark.range(100), path)
    opened = versions.read_table(spark, path)
    stop, seen, failed = threading.Event(), set(), []

    def look():
        while not stop.is_set():
            try:
                seen.add(versions.read_table(spark, path).agg(F.count("*"), F.sum("id")).first()[:])
            except Exception as error:
                failed.append(error)

    reader = threading.Thread(target=look)
    reader.start()
    for n in range(1, 7):
        versions.replace_table(spark.range(100 + n), path)
    stop.set()
    reader.join()
    assert not failed and seen <= {(100 + n, sum(range(100 + n))) for n in range(7)}
    assert opened.count() == 100 and versions.read_table(spark, path).count() == 106
    assert versions.drop_old(spark, path) == 6 and versions.read_table(spark, path).count() == 106


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace_table(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        versions.replace_table(broken, path)
    assert versions.read_table(spark, path).count() == 5
    versions.replace_table(versions.read_table(spark, path).where("id > 2"), path)
    assert sorted(r.id for r in versions.read_table(spark, path).collect()) == [3, 4]


def files_of(folder):
    return {(d, f): os.stat(f"{d}/{f}").st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_a_day_is_replaced_alone(spark, tmp_path):
    path = f"{tmp_path}/days"
    rows = spark.range(300).select("id", F.concat(F.lit("2024-01-0"), F.col("id") % 3 + 1).alias("reading_date"))
    write_curated(rows, path, partition_by="reading_date")
    before = files_of(path)
    late = rows.where("reading_date = '2024-01-02'").withColumn("id", F.col("id") + 1000)
    versions.replace_days(late.limit(7), path)
    after = files_of(path)
    kept = {f: at for f, at in before.items() if "2024-01-02" not in f[0]}
    assert kept.items() <= after.items() and all("2024-01-02" in f[0] for f in after.keys() - kept.keys())
    counts = dict(spark.read.parquet(path).groupBy(F.col("reading_date").cast("string")).count().collect())
    assert counts == {"2024-01-01": 100, "2024-01-02": 7, "2024-01-03": 100}


def feed(folder, parts):
    for part in parts:
        (folder / f"{part:03}.json").write_text("".join(f"{part}-{i}\n" for i in range(20)))


def test_compaction_keeps_all_rows_while_the_stream_goes_on(spark, tmp_path):
    folder, out, packed = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/packed"
    folder.mkdir()
    done = 0
    for more in (4, 3, 9):  # the log is compacted by Spark after ten batches
        feed(folder, range(done, done + more))
        done += more
        want = sorted(f"{p}-{i}" for p in range(done) for i in range(20))
        al.run(al.start_alerts(json_events_stream(spark, str(folder), 1), out, f"{tmp_path}/c", interval=None))
        (tmp_path / "out" / "part-half-written.parquet").write_bytes(b"PAR1")
        if more != 4:  # before: the table of an earlier batch, and what was committed since
            assert sorted(r.value for r in versions.read_compacted(spark, out, packed).collect()) == want
        assert versions.compact(spark, out, packed) == more
        assert versions.compact(spark, out, packed) is None
        got = versions.read_compacted(spark, out, packed)
        assert sorted(r.value for r in got.collect()) == want
        assert len(got.inputFiles()) <= 2
    assert versions.drop_old(spark, packed) == 2
    assert versions.read_compacted(spark, out, packed).count() == done * 20


def test_compaction_of_nothing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        versions.read_compacted(spark, f"{tmp_path}/none", f"{tmp_path}/packed")
