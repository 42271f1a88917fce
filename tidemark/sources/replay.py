"""The archive as a stream, in the order of the dates in its files' names.

Spark's file stream goes by modification times, which change when files are copied. This source
keeps a place in the list of files sorted by date and path: a file and a byte in it. A batch
admits a number of rows, over as many files as that takes. The driver lists files and counts line
feeds of the bytes that it admits; the rows themselves are read by the executors, in pieces.

Files are opened through Arrow's file systems (local or shared folders, S3, GCS, HDFS).
"""

import csv
import re
import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.functions.text import FILE_DATE_PATTERN
from tidemark.schemas import ARCHIVE_ROW
from tidemark.sources.files import ARCHIVE_PREFIX, ARCHIVE_SUFFIX, UNREADABLE

# Executors get this module with each task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a file that one task reads.
PIECE_BYTES = 16_000_000
#: Bytes that the driver looks at, at once, for line feeds.
LOOK_BYTES = 1_000_000


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _place(date: str, path: str, byte: int) -> dict:
    return {"date": date, "path": path, "byte": byte}


def list_files(folder: str, prefix: str, suffix: str) -> list[tuple[str, str, int]]:
    """(date, path, bytes) of the files with that prefix and suffix at any depth, by date and path;
    a file without a date comes first. A folder that does not exist has none."""
    system, root = _open(folder)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    files = []
    for f in found:
        if f.type == fs.FileType.File and f.base_name.startswith(prefix) and f.base_name.endswith(suffix):
            date = re.search(FILE_DATE_PATTERN, f.path)
            files.append((date.group(1) if date else "", f.path, f.size))
    return sorted(files)


def rows_end(source, begin: int, size: int, rows: int) -> tuple[int, int]:
    """The byte after ``rows`` lines from ``begin`` on, the header not counted, or the end; and
    how many lines that is."""
    source.seek(begin)
    left, at = rows + (begin == 0), begin
    while at < size:
        data = source.read(min(LOOK_BYTES, size - at))
        n = data.count(b"\n")
        if n >= left:
            cut = -1
            for _ in range(left):
                cut = data.index(b"\n", cut + 1)
            return at + cut + 1, rows
        left, at, last = left - n, at + len(data), data[-1:]
    return size, rows - left + (at > begin and last != b"\n")


@dataclass
class Piece(InputPartition):
    """The lines of a file that begin in some bytes of it; ``begin`` may lie inside a line."""
    path: str
    begin: int
    end: int


class ReplayReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str], schema: T.StructType):
        self.folder = options["path"]
        self.names = (options.get("prefix", ARCHIVE_PREFIX), options.get("suffix", ARCHIVE_SUFFIX))
        self.rows = int(options.get("rowsPerBatch", 0))
        self.newest_first = options.get("newestFirst", "false").lower() == "true"
        self.piece_bytes = int(options.get("pieceBytes", PIECE_BYTES))
        self.columns = [f.name for f in schema]
        self.place: dict | None = None

    def _from(self, place: dict) -> Iterator[tuple[str, str, int, int]]:
        """(date, path, first byte, size) of the files from a place on."""
        files = list_files(self.folder, *self.names)
        now = (place["date"], place["path"])
        for date, path, size in reversed(files) if self.newest_first else files:
            if place["path"] and (date, path) == now:
                yield date, path, place["byte"], size
            elif not place["path"] or ((date, path) < now) == self.newest_first:
                yield date, path, 0, size

    def initialOffset(self) -> dict:
        return _place("", "", 0)

    def latestOffset(self) -> dict:
        place, left = self.place or self.initialOffset(), self.rows
        for date, path, begin, size in self._from(place):
            if size <= begin:
                continue
            end = size
            if self.rows:
                system, _ = _open(self.folder)
                with system.open_input_file(path) as source:
                    end, n = rows_end(source, begin, size, left)
                left -= n
            place = _place(date, path, end)
            if self.rows and left <= 0:
                break
        self.place = place
        return place

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        # After a restart Spark first asks for what it had planned last, and so tells where it was.
        self.place = self.place or end
        pieces = []
        if start == end:
            return pieces
        for date, path, begin, size in self._from(start):
            last = (date, path) == (end["date"], end["path"])
            stop = end["byte"] if last else size
            for a in range(begin, stop, self.piece_bytes):
                pieces.append(Piece(path, a, min(a + self.piece_bytes, stop)))
            if last:
                break
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.folder)
        with system.open_input_file(partition.path) as source:
            header, lines = read_lines(source, partition.begin, partition.end)
        if lines:
            yield parse_lines(header, lines, self.columns, partition.path)


def read_lines(source, begin: int, end: int) -> tuple[bytes, bytes]:
    """A file's header and its other lines that begin in [begin, end), whole."""
    def line_end(at: int) -> int:
        source.seek(at)
        while data := source.read(4096):
            cut = data.find(b"\n")
            if cut >= 0:
                return at + cut + 1
            at += len(data)
        return at

    first = line_end(0)
    source.seek(0)
    header = source.read(first)
    begin = max(line_end(begin - 1) if begin else first, first)
    if begin >= end:
        return header, b""
    stop = line_end(end - 1)
    source.seek(begin)
    return header, source.read(stop - begin)


def parse_lines(header: bytes, lines: bytes, columns: list[str], path: str) -> pa.RecordBatch:
    """CSV lines as text columns, bound by the header's names in any case; columns that the header
    lacks are null. A line with another number of fields is a row of its own, whole in
    ``UNREADABLE``. An empty field is null, an empty text in quotes is not."""
    names = next(csv.reader([header.decode("utf-8-sig", "replace").rstrip("\r\n")]), [])
    wrong: list[str] = []

    def set_aside(row) -> str:
        wrong.append(row.text)
        return "skip"

    places = [f"c{i}" for i in range(len(names))]
    text = lines.decode("utf-8", "replace").encode()
    parsed = pa.csv.read_csv(
        pa.BufferReader(text),
        read_options=pa.csv.ReadOptions(column_names=places, use_threads=False, block_size=len(text) + 1),
        parse_options=pa.csv.ParseOptions(invalid_row_handler=set_aside),
        convert_options=pa.csv.ConvertOptions(
            column_types=dict.fromkeys(places, pa.string()), strings_can_be_null=True,
            quoted_strings_can_be_null=False, null_values=[""]),
    )
    spelt = {n.lower(): i for i, n in reversed(list(enumerate(names)))}
    spelt |= {n: i for i, n in reversed(list(enumerate(names)))}
    out = []
    for name in columns:
        at = spelt.get(name, spelt.get(name.lower()))
        if name == UNREADABLE:
            out.append(pa.array([None] * parsed.num_rows + wrong, pa.string()))
        elif name == "file_path":
            out.append(pa.array([path] * (parsed.num_rows + len(wrong)), pa.string()))
        else:
            known = parsed.column(at).combine_chunks() if at is not None else pa.nulls(parsed.num_rows, pa.string())
            out.append(pa.concat_arrays([known, pa.nulls(len(wrong), pa.string())]))
    return pa.RecordBatch.from_arrays(out, columns)


class ArchiveReplay(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive_replay"

    def schema(self) -> T.StructType:
        return T.StructType([*ARCHIVE_ROW.fields]).add("file_path", "string").add(UNREADABLE, "string")

    def streamReader(self, schema: T.StructType) -> ReplayReader:
        return ReplayReader(self.options, schema)


def replay_by_name(
    spark: SparkSession,
    folder: str,
    rows_per_batch: int | None = None,
    newest_first: bool = False,
    prefix: str = ARCHIVE_PREFIX,
    suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """The archive's rows as a stream of text, files in the order of the dates in their names.

    ``rows_per_batch`` is how many rows a micro-batch takes, so the archive is replayed at a
    steady rate under a trigger with an interval; without it a batch takes all there is. Files
    that come later are taken up if they sort behind the place reached; a finished file must
    not change. A line feed ends a row. Rows have ``file_path``, and lines that are no rows of
    their file come in ``_corrupt_record``.

    Use a trigger with an interval: one of ``availableNow`` ends with the first batch.
    """
    spark.dataSource.register(ArchiveReplay)
    reader = spark.readStream.format("archive_replay").options(
        prefix=prefix, suffix=suffix, newestFirst=str(newest_first).lower())
    if rows_per_batch:
        reader = reader.option("rowsPerBatch", rows_per_batch)
    return reader.load(folder)
