"""Token ids in files of independent Zstandard frames.

A file is a sequence of frames, each the little-endian 32-bit ids of one document (of a part of
``FRAME_IDS`` ids, for longer ones), then a skippable frame that says whose they are, then a
seek table in the seekable format of Zstandard: of each frame the packed size, the unpacked size
and a checksum. Any Zstandard decoder unpacks a file to its ids, and a reader of some documents
fetches the end of the file and the frames of these documents only.

The table ``manifest`` in the folder lists the files, in the documents' order. Executors read and
write the files with Arrow's file systems (local or shared folders, S3, GCS, HDFS).
"""

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_settings
from tidemark.llm.packing import PART, TOKENIZER, token_ids
from tidemark.llm.words import blocks, column_of

END_ID = 2
#: Most ids in a frame.
FRAME_IDS = 1 << 20
#: Bytes after which a file is closed and the next one begun.
FILE_BYTES = 256_000_000
#: Bytes that a reader fetches or hands on at once.
READ_BYTES = 8_000_000
LEVEL = 3

# Fixed values of the seekable format: marks of a skippable frame, of the seek table and of its
# end; the flag that says that entries have checksums.
INDEX_MARK, TABLE_MARK, FOOTER_MARK, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
FOOTER, FOOTER_SIZE = "<IBI", 9  # number of frames, flags, mark
HEADER, HEADER_SIZE = "<II", 8  # mark, bytes that follow
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
DOC = np.dtype([("doc_id", "<i8"), ("n", "<u8"), ("known", "u1")])
LAYOUT, LAYOUT_SIZE = "<QII", 16  # number of documents, ids in a frame, checksum of the list

MANIFEST = ("part int, piece int, path string, n_docs long, n_ids long, "
            "first_id long, last_id long, n_bytes long")


def checksum(data) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class FileWriter:
    """Frames of documents, one after the other, into one file."""

    def __init__(self, path: str, frame_ids: int = FRAME_IDS):
        self.path, self.frame_ids = path, frame_ids
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        system, place = _open(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(place, compression=None)
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.n_bytes = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for i in range(0, max(len(ids), 1), self.frame_ids):
            raw = ids[i : i + self.frame_ids].astype("<u4").tobytes()
            packed = self.packer.compress(raw)
            self.out.write(packed)
            self.entries.append((len(packed), len(raw), checksum(raw)))
            self.n_bytes += len(packed)
        self.docs.append((doc_id or 0, len(ids), doc_id is not None))
        self.n_ids += len(ids)

    def close(self) -> tuple:
        """Writes the list of documents and the seek table; the file's row in the manifest."""
        docs = np.array(self.docs, DOC).tobytes()
        index = struct.pack(LAYOUT, len(self.docs), self.frame_ids, checksum(docs)) + self.packer.compress(docs)
        frame = struct.pack(HEADER, INDEX_MARK, len(index)) + index
        table = np.array([*self.entries, (len(frame), 0, checksum(b""))], ENTRY)
        tail = struct.pack(HEADER, TABLE_MARK, table.nbytes + FOOTER_SIZE) + table.tobytes()
        tail += struct.pack(FOOTER, len(table), CHECKSUMS, FOOTER_MARK)
        self.out.write(frame + tail)
        self.out.close()
        known = [d for d, _, k in self.docs if k]
        return (self.path, len(self.docs), self.n_ids, min(known, default=None),
                max(known, default=None), self.n_bytes + len(frame) + len(tail))


@dataclass
class FileIndex:
    """What the end of a file says."""
    path: str
    doc_id: np.ndarray
    known: np.ndarray  # whether the document has an id
    n_ids: np.ndarray
    first: np.ndarray  # of each document its first frame; one more: the number of frames
    offset: np.ndarray  # of each frame; one more: where the last one ends
    size: np.ndarray
    check: np.ndarray


def read_index(source, path: str) -> FileIndex:
    """The index of an open file, from its end."""
    def wrong(what: str) -> ValueError:
        return ValueError(f"{path}: {what}")

    end = source.size()
    source.seek(max(end - FOOTER_SIZE, 0))
    footer = source.read(FOOTER_SIZE)
    if len(footer) < FOOTER_SIZE or struct.unpack(FOOTER, footer)[2] != FOOTER_MARK:
        raise wrong("no seek table")
    n, flags, _ = struct.unpack(FOOTER, footer)
    if not flags & CHECKSUMS:
        raise wrong("a seek table without checksums")
    begin = end - FOOTER_SIZE - n * ENTRY.itemsize - HEADER_SIZE
    source.seek(max(begin, 0))
    head = source.read(HEADER_SIZE)
    if begin < 0 or struct.unpack(HEADER, head) != (TABLE_MARK, n * ENTRY.itemsize + FOOTER_SIZE):
        raise wrong("a damaged seek table")
    table = np.frombuffer(source.read(n * ENTRY.itemsize), ENTRY)
    offset = np.append(0, np.cumsum(table["packed"], dtype=np.int64))
    if n < 1 or offset[-1] != begin:
        raise wrong("frames that do not fill the file")
    source.seek(int(offset[-2]))
    frame = source.read(int(table["packed"][-1]))
    if struct.unpack_from(HEADER, frame) != (INDEX_MARK, len(frame) - HEADER_SIZE):
        raise wrong("no list of documents")
    n_docs, frame_ids, check = struct.unpack_from(LAYOUT, frame, HEADER_SIZE)
    raw = zstandard.ZstdDecompressor().decompress(frame[HEADER_SIZE + LAYOUT_SIZE :])
    if checksum(raw) != check or len(raw) != n_docs * DOC.itemsize:
        raise wrong("a damaged list of documents")
    docs = np.frombuffer(raw, DOC)
    n_ids = docs["n"].astype(np.int64)
    first = np.append(0, np.cumsum(np.maximum(-(-n_ids // frame_ids), 1)))
    if first[-1] != n - 1:
        raise wrong("frames without a document")
    return FileIndex(path, docs["doc_id"], docs["known"].astype(bool), n_ids, first,
                     offset[:-1], table["size"][:-1], table["check"][:-1])


def read_documents(source, index: FileIndex, docs: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(document, the bytes of its ids) for some documents of a file, given by their rising
    places in it. Only their frames are fetched, neighbouring ones together, and unpacked."""
    unpacker = zstandard.ZstdDecompressor()
    k = 0
    while k < len(docs):
        m = k + 1  # documents whose frames follow each other
        start = index.offset[index.first[docs[k]]]
        while (m < len(docs) and docs[m] == docs[m - 1] + 1
               and index.offset[index.first[docs[m] + 1]] - start <= READ_BYTES):
            m += 1
        source.seek(int(start))
        packed = source.read(int(index.offset[index.first[docs[m - 1] + 1]] - start))
        for doc in docs[k:m].tolist():
            whole = []
            for f in range(index.first[doc], index.first[doc + 1]):
                a, b = index.offset[f] - start, index.offset[f + 1] - start
                raw = unpacker.decompress(packed[a:b])
                if len(raw) != index.size[f] or checksum(raw) != index.check[f]:
                    raise ValueError(f"{index.path}: frame {f} is damaged")
                whole.append(raw)
            yield doc, b"".join(whole)
        k = m


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
    frame_ids: int = FRAME_IDS, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes each document's ids, closed by ``end_id``, in ascending order of doc_id, and
    returns the manifest: one row per file.

    A null text is empty. Null ids come last; rows of one id go by a hash of the text, and equal
    rows are as many documents, which may lie in several files. An empty table gives a manifest
    without files. Other columns are not read.

    Every task writes files of names of its own and lists them only when they are complete, so
    a task that is repeated leaves no trace in the manifest; what its first attempt wrote is
    unlisted, for :func:`remove_unlisted`.
    """
    spark = arrow_settings(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_last(), F.col("_t")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_t"))
    dealt = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*order, "_salt")
    dealt = dealt.sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches):
        part, piece, out = TaskContext.get().partitionId(), 0, None

        def closed():
            row = (part, piece, *out.close())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], names)

        names = [c.split()[0] for c in MANIFEST.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
        types = [kinds[c.split()[1]] for c in MANIFEST.split(", ")]
        for table in blocks(batches, "text", PART):
            ids, place = token_ids(column_of(table, "text"), tokenizer, end_id)
            place = place.tolist()
            for i, doc_id in enumerate(column_of(table, "doc_id").to_pylist()):
                out = out or FileWriter(
                    f"{folder}/ids-{part:06d}-{piece:04d}-{uuid.uuid4().hex}.zst", frame_ids)
                out.add(doc_id, ids[place[i] : place[i + 1]])
                if out.n_bytes >= file_bytes:
                    yield closed()
                    piece, out = piece + 1, None
        if out:
            yield closed()

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder with ``start``, the number of ids in the files before each."""
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def remove_unlisted(spark: SparkSession, folder: str) -> list[str]:
    """Deletes the files of tasks that did not end well, once nothing writes any more."""
    listed = {r.path.rpartition("/")[2] for r in manifest(spark, folder).select("path").collect()}
    system, place = _open(folder)
    found = system.get_file_info(fs.FileSelector(place))
    gone = [f.path for f in found if f.base_name.startswith("ids-") and f.base_name not in listed]
    for path in gone:
        system.delete_file(path)
    return gone


def _result(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    doc_id, start, raw = zip(*rows)
    columns = {
        "doc_id": pa.array(doc_id, pa.int64()), "start": pa.array(start, pa.int64()),
        "n_tokens": pa.array([len(r) // 4 for r in raw], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64()),
    }
    if with_ids:
        edges = np.append(0, np.cumsum([len(r) // 4 for r in raw]))
        flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
        columns["ids"] = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))
    return pa.RecordBatch.from_pydict(columns)


def _read(source, index: FileIndex, docs: np.ndarray, base: int, with_ids: bool):
    starts = base + np.append(0, np.cumsum(index.n_ids))
    rows, size = [], 0
    for doc, raw in read_documents(source, index, docs):
        rows.append((int(index.doc_id[doc]) if index.known[doc] else None, int(starts[doc]), raw))
        size += len(raw)
        if size >= READ_BYTES:
            yield _result(rows, with_ids)
            rows, size = [], 0
    if rows:
        yield _result(rows, with_ids)


def _schema(with_ids: bool) -> str:
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return columns + (", ids array<int>" if with_ids else "")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """All documents of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (and ids). Each file is read by one task, a few megabytes at a time."""
    files = manifest(spark, folder).select("path", "start")
    n = max(files.count(), 1)

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _open(row["path"])
                with system.open_input_file(place) as source:
                    index = read_index(source, row["path"])
                    docs = np.arange(len(index.doc_id))
                    yield from _read(source, index, docs, row["start"], with_ids)

    return files.repartition(n, "path").mapInArrow(read, _schema(with_ids))


def find_tokens(
    spark: SparkSession, folder: str, wanted: DataFrame, with_ids: bool = True
) -> DataFrame:
    """The documents whose doc_id is in ``wanted``, as in :func:`read_tokens`.

    Of a file that holds some of them only its end and their frames are read. An id counts once
    however often it is asked for, one that is in no file gives nothing, and a null asks for
    nothing. All documents that share an id are found. The driver sends the list of files
    with the first and last id of each to the tasks, as Spark does with the files of a scan.
    """
    files = [r for r in manifest(spark, folder).orderBy("part", "piece").collect()
             if r.first_id is not None]
    paths = [r.path for r in files]
    bases = np.array([r.start for r in files], np.int64)
    low = np.array([r.first_id for r in files], np.int64)
    high = np.array([r.last_id for r in files], np.int64)

    def locate(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0), np.int64)
            a, b = np.searchsorted(high, ids, "left"), np.searchsorted(low, ids, "right")
            n = np.maximum(b - a, 0)
            which = np.repeat(np.arange(len(ids)), n)
            file = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + a[which]
            yield pa.RecordBatch.from_pydict(
                {"file": pa.array(file, pa.int64()), "doc_id": pa.array(ids[which], pa.int64())})

    def read(batches):
        now, source, index = None, None, None
        for batch in batches:
            numbers = np.asarray(batch.column(0), np.int64)
            ids = np.asarray(batch.column(1), np.int64)
            for file in dict.fromkeys(numbers.tolist()):
                if file != now:
                    if source:
                        source.close()
                    system, place = _open(paths[file])
                    now, source = file, system.open_input_file(place)
                    index = read_index(source, paths[file])
                asked = ids[numbers == file]
                docs = np.flatnonzero(index.known & np.isin(index.doc_id, asked))
                yield from _read(source, index, docs, int(bases[file]), with_ids)
        if source:
            source.close()

    ids = wanted.where("doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
    placed = ids.mapInArrow(locate, "file long, doc_id long")
    near = placed.repartition("file").sortWithinPartitions("file", "doc_id")
    return near.mapInArrow(read, _schema(with_ids))
