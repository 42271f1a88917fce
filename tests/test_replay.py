import io
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import replay as src
from tidemark.sources.replay import replay_by_name

HEADER = "dateTime,Value,parameter,label\n"


def archive(folder, days, rows=10):
    """One file a day; modification times run against the names."""
    for day in range(days):
        sub = folder / f"sub{day % 2}"
        sub.mkdir(exist_ok=True, parents=True)
        path = sub / f"readings-full-2024-01-{day + 1:02d}.csv"
        path.write_text(HEADER + "".join(f"{day:02d}-{i:03d},{i},level,x\n" for i in range(rows)))
        os.utime(path, (1e9 - day * 1000, 1e9 - day * 1000))
    (folder / "other-2024-01-01.csv").write_text(HEADER + "no,0,level,x\n")
    return [f"{d:02d}-{i:03d}" for d in range(days) for i in range(rows)]


def drain(stream, root, stop_after=None):
    """Run to the end, or stop in the middle; the rows of each batch, in the order of batches."""
    def write(batch, batch_id):
        if stop_after is not None and batch_id >= stop_after:
            raise RuntimeError("stopped by the test")
        batch.write.mode("overwrite").parquet(f"{root}/out/{batch_id:05d}")

    query = stream.writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{root}/checkpoint").trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    except Exception:
        if stop_after is None:
            raise
    finally:
        query.stop()
    spark = stream.sparkSession
    return [sorted(r.dateTime for r in spark.read.parquet(f"{root}/out/{b}").collect())
            for b in sorted(os.listdir(f"{root}/out"))]


def test_rows_come_by_name_at_the_rate_asked_for(spark, tmp_path):
    want = archive(tmp_path / "in", 5)
    got = drain(replay_by_name(spark, str(tmp_path / "in"), rows_per_batch=7), tmp_path)
    got = [b for b in got if b]
    assert [len(b) for b in got] == [7] * 7 + [1]
    assert [r for b in got for r in b] == want


def test_newest_first(spark, tmp_path):
    want = archive(tmp_path / "in", 4, 3)
    stream = replay_by_name(spark, str(tmp_path / "in"), 3, newest_first=True)
    got = [b for b in drain(stream, tmp_path) if b]
    assert got == [[r for r in want if r.startswith(f"{d:02d}")] for d in (3, 2, 1, 0)]


def test_restart_sends_nothing_twice(spark, tmp_path):
    want = archive(tmp_path / "in", 5)
    folder = str(tmp_path / "in")
    first = drain(replay_by_name(spark, folder, 6), tmp_path, stop_after=3)
    assert sum(map(len, first)) == 18
    # Another rate after the restart; the batch that failed is repeated as it was planned.
    second = drain(replay_by_name(spark, folder, 11), tmp_path)
    assert [r for b in second for r in b] == want
    later = tmp_path / "in" / "readings-full-2024-02-01.csv"
    later.write_text(HEADER + "late,1,level,x\n")
    third = drain(replay_by_name(spark, folder, 4), tmp_path)
    assert [r for b in third for r in b] == [*want, "late"]


def test_all_at_once_in_small_pieces(spark, tmp_path):
    want = archive(tmp_path / "in", 3, 40)
    spark.dataSource.register(src.ArchiveReplay)
    stream = spark.readStream.format("archive_replay").option("pieceBytes", 50).load(str(tmp_path / "in"))
    assert [r for b in drain(stream, tmp_path) for r in b] == want


def test_empty_folder_and_late_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = replay_by_name(spark, str(tmp_path / "in"), 5)
    query = stream.writeStream.format("noop").option(
        "checkpointLocation", f"{tmp_path}/checkpoint").start()
    query.processAllAvailable()
    query.stop()
    want = archive(tmp_path / "in", 2)
    assert [r for b in drain(stream, tmp_path) for r in b] == want


@pytest.mark.parametrize("piece", [1, 3, 10, 64, 10_000])
def test_pieces_hold_every_line_once(piece):
    data = b"h,e\nfirst,1\n\nsecond with some length,2\nlast,3"
    lines = []
    for a in range(0, len(data), piece):
        header, own = src.read_lines(io.BytesIO(data), a, min(a + piece, len(data)))
        assert header == b"h,e\n"
        lines.append(own)
    assert b"".join(lines) == data[4:]


def test_rows_end():
    data = b"h\n" + b"".join(b"%d\n" % i for i in range(30)) + b"end"
    source = io.BytesIO(data)
    at, seen = 0, []
    for n in (1, 5, 20, 4, 9):
        end, got = src.rows_end(source, at, len(data), n)
        seen.append(got)
        at = end
    assert seen == [1, 5, 20, 4, 1] and at == len(data)
    assert src.rows_end(source, len(data), len(data), 3) == (len(data), 0)


def test_lines_that_are_no_rows_are_set_aside():
    lines = b'a,"x,""y""",level\nshort\n"",,flow\none,two,three,four\n\xff,1,level\n'
    batch = src.parse_lines(b"\xef\xbb\xbfDATETIME,value,parameter\r\n", lines,
                            ["dateTime", "value", "measure", "file_path", src.UNREADABLE], "p")
    rows = batch.to_pylist()
    assert [r["dateTime"] for r in rows] == ["a", "", "\ufffd", None, None]
    assert [r["value"] for r in rows] == ['x,"y"', None, "1", None, None]
    assert [r[src.UNREADABLE] for r in rows] == [None, None, None, "short", "one,two,three,four"]
    assert {r["measure"] for r in rows} == {None} and {r["file_path"] for r in rows} == {"p"}


def test_rows_of_a_file_equal_the_batch_reader(spark, tmp_path):
    from tidemark.sources.files import archive_files

    archive(tmp_path / "in", 3)
    stream = replay_by_name(spark, str(tmp_path / "in"), 8)
    drain(stream, tmp_path)
    got = spark.read.option("recursiveFileLookup", True).schema(stream.schema).parquet(f"{tmp_path}/out")
    want = archive_files(spark, str(tmp_path / "in"))
    columns = [c for c in want.columns if c not in ("file_path", "file_date")]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())
    assert got.where(F.col(src.UNREADABLE).isNotNull()).count() == 0
