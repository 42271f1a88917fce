"""Tables that are replaced at once, and streams' output in fewer files.

A table is a folder with versions and marks, empty files whose names have a number and a
version. A new version is written beside the old one; then a mark with the next number is made,
which a file system does at once, while a file that is replaced may be missing for a moment. A
reader takes the version of the highest mark and goes on with it, so it sees the old table or
the new one. Old versions and marks stay until :func:`drop_old`.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sinks.files import write_curated

MARK = "_version"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _text(spark: SparkSession, name: str) -> str:
    """A small file's text; Spark's own readers skip names that begin with an underscore."""
    stream = _files(spark, name).open(_path(spark, name))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _marks(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of a table's marks, the valid one last."""
    files, folder = _files(spark, path), _path(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    found = [n.split(".")[1:] for n in names if n.startswith(f"{MARK}.")]
    return sorted((int(number), version) for number, version in found)


def _current(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that is valid now."""
    marks = _marks(spark, path)
    return f"{path}/{marks[-1][1]}" if marks else None


def _publish(spark: SparkSession, path: str, version: str) -> None:
    number = max((n for n, _ in _marks(spark, path)), default=0) + 1
    _files(spark, path).createNewFile(_path(spark, f"{path}/{MARK}.{number:09}.{version}"))


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write ``df`` as the new version of a table; the version's folder. A job that fails while
    it writes leaves the table as it was. ``df`` may read the table itself."""
    version = f"v-{uuid.uuid4().hex}"
    write_curated(df, f"{path}/{version}", partition_by)
    _publish(df.sparkSession, path, version)
    return f"{path}/{version}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The version of a table that is valid now; an error if there is none."""
    now = _current(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(now)


def read_either(spark: SparkSession, path: str) -> DataFrame:
    """A table with versions, or a plain folder of Parquet files."""
    return spark.read.parquet(_current(spark, path) or path)


def drop_old(spark: SparkSession, path: str) -> int:
    """Delete all versions but the valid one, once nothing reads or writes them; how many."""
    files, marks = _files(spark, path), _marks(spark, path)
    if not marks:
        return 0
    for number, version in marks[:-1]:
        files.delete(_path(spark, f"{path}/{MARK}.{number:09}.{version}"), False)
    old = [s.getPath() for s in files.listStatus(_path(spark, path))
           if s.getPath().getName().startswith("v-") and s.getPath().getName() != marks[-1][1]]
    for folder in old:
        files.delete(folder, True)
    return len(old)


def replace_days(df: DataFrame, path: str, partition_by: str = "reading_date") -> None:
    """Replace the partitions of a curated Parquet table that ``df`` has rows of; the files of all
    others stay as they are. For days that arrive late or are corrected."""
    together = df.hint("rebalance", F.col(partition_by))
    together.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition_by).parquet(path)


# --- Output of a stream -----------------------------------------------------------------------

LOG = "_spark_metadata"


def _new_files(spark: SparkSession, out: str, before: str | None) -> list[str]:
    """The files that a sink has committed, by its log, and that the compacted table lacks. The
    driver holds this list, as Spark does when it reads a sink's output. A compacted file of the
    log repeats those before it, which then are not read."""
    files, log = _files(spark, out), _path(spark, f"{out}/{LOG}")
    names = [s.getPath().getName() for s in files.listStatus(log)] if files.exists(log) else []
    last = max((int(n.removesuffix(".compact")) for n in names if n.endswith(".compact")), default=-1)
    taken = [n for n in names if n == f"{last}.compact" or (n.isdigit() and int(n) > last)]
    entries = [json.loads(line) for n in taken
               for line in _text(spark, f"{out}/{LOG}/{n}").splitlines() if line.startswith("{")]
    logged = [e["path"] for e in entries if e["action"] == "add"]
    if before is None:
        return logged
    old = spark.read.parquet(f"{before}/files").collect()
    return sorted(set(logged) - {r.path for r in old})


def compact(spark: SparkSession, out: str, target: str) -> int | None:
    """Rewrite what a file sink has put out so far as a table with few files; the number of
    files that were new, or None if there were none and nothing was written.

    Files are taken from the sink's own log, so half-written ones do not count, and the stream may
    go on meanwhile: what it commits later is not in the table, and :func:`read_compacted` adds
    it. The table remembers its files and is replaced at once. The sink's own files stay.
    """
    before, version = _current(spark, target), f"v-{uuid.uuid4().hex}"
    new = _new_files(spark, out, before)
    if not new:
        return None
    rows, files = spark.read.parquet(*new), spark.createDataFrame([(p,) for p in new], "path string")
    if before:
        rows = spark.read.parquet(f"{before}/rows").unionByName(rows)
        files = spark.read.parquet(f"{before}/files").unionByName(files)
    rows.hint("rebalance").write.parquet(f"{target}/{version}/rows")
    files.hint("rebalance").write.parquet(f"{target}/{version}/files")
    _publish(spark, target, version)
    return len(new)


def read_compacted(spark: SparkSession, out: str, target: str) -> DataFrame:
    """All rows that a sink has committed: those of the compacted table, and of the files that
    its log has besides. An error if there are none."""
    before = _current(spark, target)
    new = _new_files(spark, out, before)
    parts = [spark.read.parquet(f"{before}/rows")] if before else []
    if new:
        parts.append(spark.read.parquet(*new))
    if not parts:
        raise FileNotFoundError(f"nothing committed under {out}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
