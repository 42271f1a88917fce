"""File sources. A folder is one table: its files are read as a union.

Paths may be any URI Spark's file systems know, including object stores and globs.
CSV columns are bound by header name, in any case. Spark binds a declared CSV schema by position,
which would silently shift columns in a file wider than the schema, so the header is
read as all-text columns and then projected onto the declared schema. Files whose
header differs from the first one stop the read; :func:`union_by_header` is for those.
"""

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import text

# Naming of archive files and the CSV dialect (RFC 4180 quoting).
ARCHIVE_PREFIX = "readings-full-"
ARCHIVE_SUFFIX = ".csv"
CSV_DIALECT = {"header": True, "escape": '"'}
# A line or message that does not parse, whole.
UNREADABLE = "_corrupt_record"


def _header_schema(spark: SparkSession, path: str | list[str], options: dict) -> T.StructType | None:
    """All-text schema in header order, or None when there is no file."""
    try:
        return spark.read.options(**CSV_DIALECT, **options).csv(path).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def has_csv(spark: SparkSession, path: str, **options) -> bool:
    """Whether there is any file under ``path``."""
    return _header_schema(spark, path, options) is not None


def project_schema(
    df: DataFrame, schema: T.StructType, required: Iterable[str] = ()
) -> DataFrame:
    """Project onto a declared schema. Names are matched without regard to case, an exact
    match first; absent columns and unreadable values are NULL, but for absent columns that
    are ``required``: those are an error."""
    spelt = {c.lower(): c for c in df.columns} | {c: c for c in df.columns}
    found = {f.name: spelt.get(f.name, spelt.get(f.name.lower())) for f in schema}
    missing = [name for name in required if found.get(name) is None]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(df.columns)}")
    return df.select(
        *(
            (F.lit(None) if found[f.name] is None else F.col(f"`{found[f.name]}`"))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema
        )
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    with_file: bool = False,
    required: Iterable[str] = (),
    multi_line: bool = False,
    **options,
) -> DataFrame:
    """CSV files under ``path`` (or several), projected onto ``schema``.

    ``with_file`` adds the column ``file_path``. No matching file gives no rows; a header
    without a ``required`` column is an error. ``multi_line`` reads line feeds inside
    quotes as part of the value; such files are not split, so each is one task.
    """
    options["multiLine"] = multi_line
    wanted = T.StructType(schema.fields[:])
    if with_file:
        wanted.add("file_path", "string")
    header = _header_schema(spark, path, options)
    if header is None:
        return spark.createDataFrame([], wanted)
    raw = spark.read.schema(header).options(**CSV_DIALECT, enforceSchema=False, **options).csv(path)
    if with_file:
        raw = raw.select("*", F.col("_metadata.file_path").alias("file_path"))
    return project_schema(raw, wanted, required)


def read_csv_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    required: Iterable[str] = (),
    **options,
) -> tuple[DataFrame, DataFrame]:
    """CSV files as rows of ``schema``, and apart from them the lines that are none.

    The second table has ``file_path`` and ``line`` of those with more or fewer fields than the
    header, which :func:`read_csv` fills up or cuts. Every line is in one of the two, so their
    counts add up to the lines that are not empty. Write both, or store one scan, if the files
    are large: each table is a scan of its own.
    """
    header = _header_schema(spark, path, options)
    rejects = T.StructType().add("file_path", "string").add("line", "string")
    if header is None:
        return spark.createDataFrame([], schema), spark.createDataFrame([], rejects)
    with_line = T.StructType([*header.fields]).add(UNREADABLE, "string")
    raw = spark.read.schema(with_line).options(
        **CSV_DIALECT, enforceSchema=False, columnNameOfCorruptRecord=UNREADABLE,
        columnPruning=False, **options  # a parser that skips fields does not count them
    ).csv(path).select("*", F.col("_metadata.file_path").alias("file_path"))
    # Spark refuses to read that column alone, as a count would, so one of the file goes with it.
    some = F.length(F.coalesce(F.col(f"`{header.names[0]}`"), F.lit(""))) >= 0
    good = raw.where(F.col(UNREADABLE).isNull() & some).drop(UNREADABLE, "file_path")
    bad = raw.where(F.col(UNREADABLE).isNotNull() & some)
    return project_schema(good, schema, required), bad.select("file_path", F.col(UNREADABLE).alias("line"))


def read_readings(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw readings: time, measure URI and the value as text."""
    return read_csv(spark, path, schemas.READINGS, required=schemas.READINGS.names, **options)


def read_stations(spark: SparkSession, path: str, **options) -> DataFrame:
    """Station metadata."""
    return read_csv(spark, path, schemas.STATIONS, required=[schemas.STATION_KEY], **options)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Curated baseline table (Parquet carries its own schema)."""
    return spark.read.parquet(path)


def read_archive_text(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Archive rows with every column as text."""
    return read_csv(spark, path, schemas.ARCHIVE_ROW, **options)


def selection(prefix: str, suffix: str) -> dict:
    """Reader options that pick files by name, at any depth."""
    return {"pathGlobFilter": f"{prefix}*{suffix}", "recursiveFileLookup": True}


def archive_files(
    spark: SparkSession,
    folder: str | list[str],
    prefix: str = ARCHIVE_PREFIX,
    suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """Rows of the files whose name has the prefix and suffix, with ``file_path`` and
    the ``file_date`` stamped into the path."""
    rows = read_archive_text(spark, folder, with_file=True, **selection(prefix, suffix))
    return rows.withColumn("file_date", text.file_date(F.col("file_path")))


def archive_order(archive: DataFrame, newest_first: bool = False) -> DataFrame:
    """The archive's files in replay order: ``position`` from 1 on and row counts.

    The date in the name decides, then the path. One row per file, so only the file list is
    numbered in one place, never the readings.
    """
    keys = [F.col("file_date"), F.col("file_path")]
    order = Window.orderBy(*(k.desc() if newest_first else k.asc() for k in keys))
    files = archive.groupBy("file_path", "file_date").agg(F.count("*").alias("n_rows"))
    return files.withColumn("position", F.row_number().over(order)).orderBy("position")


def list_archive(
    spark: SparkSession,
    folder: str,
    newest_first: bool = False,
    prefix: str = ARCHIVE_PREFIX,
    suffix: str = ARCHIVE_SUFFIX,
) -> list[str]:
    """Paths of the archive's files in replay order, from a listing; no file is read."""
    found = spark.read.format("binaryFile").options(**selection(prefix, suffix)).load(folder)
    path = F.col("_metadata.file_path")
    files = found.select(text.file_date(path).alias("file_date"), path.alias("file_path"))
    keys = [F.col("file_date").asc_nulls_first(), F.col("file_path")]
    rows = files.orderBy(*keys).collect()
    return [r.file_path for r in (reversed(rows) if newest_first else rows)]


def replay_all(spark: SparkSession, folder: str, schema: T.StructType, **options) -> DataFrame:
    """UNION ALL of a folder's files as one multi-file scan."""
    return read_csv(spark, folder, schema, **options)


def union_by_header(spark: SparkSession, paths: list[str]) -> DataFrame:
    """UNION ALL of CSV paths whose headers differ; missing columns become NULL.

    Give one path (folder or glob) per header, not one per file.
    """
    parts = [spark.read.options(**CSV_DIALECT).csv(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def replay_stream(
    spark: SparkSession,
    folder: str,
    latest_first: bool = False,
    max_files: int | None = None,
    prefix: str = ARCHIVE_PREFIX,
    suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """Archive files as a stream of text rows, oldest file (by modification time) first.

    Modification times change when files are copied; :func:`tidemark.sources.replay.replay_by_name`
    goes by the date in the name.

    ``max_files`` throttles the files per micro-batch. Replaying the latest file first
    under a watermark drops the older files as late, hence the default.
    """
    options = selection(prefix, suffix)
    header = _header_schema(spark, folder, options) or schemas.ARCHIVE_ROW
    reader = spark.readStream.schema(header).options(
        **CSV_DIALECT, **options, enforceSchema=False, latestFirst=latest_first
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return project_schema(reader.csv(folder), schemas.ARCHIVE_ROW)


def json_events_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON-lines files as a stream of messages (column ``value``)."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)
