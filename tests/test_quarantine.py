import pytest

from tidemark.schemas import LEVEL_EVENT, READINGS
from tidemark.sources.files import json_events_stream, read_csv, read_csv_checked
from tidemark.streaming import alerts as al
from tidemark.streaming import quarantine as qu
from tidemark.streaming.events import parse_events, valid_events

GOOD = '{"stationReference":"a","dateTime":"2024-01-01T00:00:00Z","value":1.5}'
MESSAGES = {
    GOOD: None,
    '{"dateTime":"2024-01-01T00:00:00Z","stationReference":"b","extra":[1]}': None,
    '{"stationReference":"a","dateTime":null,"value":1}': qu.NO_KEY,
    "{}": qu.NO_KEY,
    "": qu.MALFORMED, "  ": qu.MALFORMED, "garbage": qu.MALFORMED, GOOD[:-5]: qu.MALFORMED,
    GOOD.replace("1.5", '"1.5"'): qu.MALFORMED, GOOD.replace("2024-01-01", "2024-13-01"): qu.MALFORMED,
    None: qu.MALFORMED,
}


@pytest.mark.parametrize("schema", [LEVEL_EVENT, None])
def test_every_message_is_accepted_or_rejected(rows, schema):
    messages = rows("value string", *[(m,) for m in MESSAGES])
    args = [schema] if schema else []
    checked = qu.checked_events(messages, *args)
    bad = {r.message: r.reject_reason for r in qu.rejected(checked).collect()}
    assert bad == {m: reason for m, reason in MESSAGES.items() if reason}
    good = qu.accepted(checked)
    assert good.count() == 2
    plain = valid_events(parse_events(rows("value string", *[(m,) for m, r in MESSAGES.items() if not r]), *args))
    assert sorted(map(str, good.collect())) == sorted(map(str, plain.collect()))


def test_rejects_of_a_stream_appear_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(3):
        (folder / f"{part}.json").write_text(f"{GOOD}\nbad {part}\n{{}}\n")
    for _ in range(2):  # again from the checkpoint
        al.run(qu.start_quarantine(json_events_stream(spark, str(folder), 1), f"{tmp_path}/out",
                                   f"{tmp_path}/c", interval=None))
    got = sorted((r.message, r.reject_reason) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted([*((f"bad {p}", qu.MALFORMED) for p in range(3)), *[("{}", qu.NO_KEY)] * 3])


def test_lines_that_are_no_rows(spark, tmp_path):
    lines = ["t,m,1", "short", "a,b", '"x,""y""",m,2', "t,m,3,4", ",,", "t,m,five"]
    for part in range(2):
        (tmp_path / f"{part}.csv").write_text("dateTime,measure,Value\n" + "\n".join(lines) + "\n")
    good, bad = read_csv_checked(spark, str(tmp_path), READINGS, required=["value"])
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [("t", "m", "1"), ('x,"y"', "m", "2"), (None, None, None), ("t", "m", "five")] * 2, key=str)
    assert sorted(r.line for r in bad.collect()) == sorted(["short", "a,b", "t,m,3,4"] * 2)
    assert good.count() + bad.count() == read_csv(spark, str(tmp_path), READINGS).count() == 14
    assert {r.file_path.rpartition("/")[2] for r in bad.collect()} == {"0.csv", "1.csv"}
    (tmp_path / "none").mkdir()
    good, bad = read_csv_checked(spark, str(tmp_path / "none"), READINGS)
    assert good.count() == bad.count() == 0 and bad.columns == ["file_path", "line"]
