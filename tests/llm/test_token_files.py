import random
import zlib

import numpy as np
import pyarrow.fs
import pytest
import xxhash
import zstandard
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.test_dedup import DOCS, odd_documents
from tidemark.llm import packing, queries, token_files

SCHEMA = "doc_id long, text string"


def plain(rows):
    """[(doc_id, start, n_tokens, crc32)] in order, for [(doc_id, text)] without ties."""
    tokenizer, out, at = Tokenizer.from_file(packing.TOKENIZER), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def digests(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()),
                  key=lambda r: r[1])


def test_query_equals_the_tokenizer(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert digests(queries.QUERIES["op13_token_files"](spark, SMALL)) == plain(rows)


def test_round_trip_of_odd_rows(spark, tmp_path):
    rows = [(i, t) for i, (_, t) in enumerate(odd_documents())]
    rows += [(2**62, "<|endoftext|> x"), (-5, None), (None, "no id"), (10**6, "word " * 30_000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 7, "y") for r in rows], SCHEMA + ", start int, path string")
    files = token_files.write_tokens(df.repartition(5), f"{tmp_path}/a", frame_ids=1000, file_bytes=300)
    assert digests(token_files.read_tokens(spark, f"{tmp_path}/a")) == plain(rows)
    assert files.count() > 4
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    whole = {r.doc_id: r.ids for r in token_files.read_tokens(spark, f"{tmp_path}/a", True).collect()}
    for doc_id, text in rows:
        assert whole[doc_id] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_repeated_rows_and_ids(spark, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (0, "d"), (None, None), (None, None)] * 40
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    token_files.write_tokens(df, f"{tmp_path}/a", file_bytes=200)
    got = digests(token_files.read_tokens(spark, f"{tmp_path}/a"))
    one = {text: plain([(0, text)])[0][2:] for _, text in rows}
    assert sorted((str(r[0]), *r[2:]) for r in got) == sorted((str(d), *one[t]) for d, t in rows)
    at = 0
    for doc_id, start, n, _ in got:
        assert start == at
        at += n
    order = [r[0] for r in got]
    assert order == sorted(order, key=lambda d: (d is None, d))
    wanted = spark.createDataFrame([(1,), (1,), (None,), (77,)], "doc_id long")
    found = digests(token_files.find_tokens(spark, f"{tmp_path}/a", wanted))
    assert found == [r for r in got if r[0] == 1]


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    assert token_files.write_tokens(df, f"{tmp_path}/a").count() == 0
    assert token_files.read_tokens(spark, f"{tmp_path}/a").count() == 0
    wanted = spark.createDataFrame([(1,)], "doc_id long")
    assert token_files.find_tokens(spark, f"{tmp_path}/a", wanted).count() == 0


def one_file(tmp_path, texts, frame_ids=8):
    path = f"{tmp_path}/one.zst"
    out = token_files.FileWriter(path, frame_ids)
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 49408, n, dtype=np.uint32) for n in texts]
    for i, ids in enumerate(docs):
        out.add(i * 10, ids)
    out.close()
    return path, docs


class Counted:
    """A file that remembers which bytes were read."""

    def __init__(self, path):
        self.source, self.reads = open(path, "rb"), []

    def size(self):
        return self.source.seek(0, 2)

    def seek(self, at):
        self.source.seek(at)

    def read(self, n):
        self.reads.append((self.source.tell(), n))
        return self.source.read(n)


def test_only_the_wanted_frames_are_read(tmp_path):
    path, docs = one_file(tmp_path, [5, 1, 30, 8, 400, 9, 16])
    source = Counted(path)
    index = token_files.read_index(source, path)
    assert index.first.tolist() == [0, 1, 2, 6, 7, 57, 59, 61]
    source.reads.clear()
    got = dict(token_files.read_documents(source, index, np.array([1, 2, 5])))
    assert {k: np.frombuffer(v, "<u4").tolist() for k, v in got.items()} == {
        k: docs[k].tolist() for k in (1, 2, 5)}
    spans = [(int(index.offset[index.first[a]]), int(index.offset[index.first[b]]))
             for a, b in ((1, 3), (5, 6))]
    assert source.reads == [(a, b - a) for a, b in spans]


def test_files_follow_the_seekable_format(tmp_path):
    path, docs = one_file(tmp_path, [5, 1, 30])
    data = open(path, "rb").read()
    with open(path, "rb") as source:  # any decoder gives the ids, and skips the rest
        reader = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)
        assert reader.read() == np.concatenate(docs).astype("<u4").tobytes()
    n = int.from_bytes(data[-9:-5], "little")
    assert data[-5] == 0x80 and data[-4:] == bytes.fromhex("b1ea928f")
    table = np.frombuffer(data[-9 - 12 * n : -9], "<u4").reshape(n, 3)
    assert data[-17 - 12 * n : -13 - 12 * n] == bytes.fromhex("5e2a4d18")
    assert table[:, 0].sum() == len(data) - 17 - 12 * n
    raw = docs[0].astype("<u4").tobytes()
    assert table[0, 1] == len(raw) and table[0, 2] == xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


@pytest.mark.parametrize("where", ["frame", "list", "table", "cut"])
def test_damage_is_noticed(tmp_path, where):
    path, docs = one_file(tmp_path, [50, 60])
    data = bytearray(open(path, "rb").read())
    n = int.from_bytes(data[-9:-5], "little")
    at = {"frame": 20, "list": -17 - 12 * n - 3, "table": -9 - 12 * n, "cut": None}[where]
    if at is None:
        data = data[:-20]
    else:
        data[at] ^= 1
    open(path, "wb").write(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        with pyarrow.fs.LocalFileSystem().open_input_file(path) as source:
            index = token_files.read_index(source, path)
            list(token_files.read_documents(source, index, np.arange(2)))


def test_files_of_failed_tasks_are_removed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    token_files.write_tokens(df, f"{tmp_path}/a")
    left = tmp_path / "a" / "ids-000009-0000-half.zst"
    left.write_bytes(b"half")
    assert [p.rpartition("/")[2] for p in token_files.remove_unlisted(spark, f"{tmp_path}/a")] == [left.name]
    assert len(digests(token_files.read_tokens(spark, f"{tmp_path}/a"))) == 2
