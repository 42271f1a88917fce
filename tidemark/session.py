"""Session set-up and the shared scratch folder.

Library code works on the caller's session; only the command-line entry points
build and stop one.
"""

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session-level SQL settings the operators are designed for.
#  * UTC: instants and calendar days mean the same on every machine.
#  * AQE: measured-size broadcast, coalesced shuffles, split skewed partitions, the last
#    also where the split costs one more shuffle after the join.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# State lives in RocksDB (off heap, spilling to disk) with changelog checkpoints, so
# neither the number of live stations nor the snapshot size is bound by the heap. State rows
# are not counted (``numRowsTotal`` of the progress is 0): that takes one more read for each write.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app_name: str, log_level: str = "WARN") -> SparkSession:
    """Get or create a named session with the settings above."""
    spark = apply_settings(SparkSession.builder.appName(app_name).getOrCreate())
    spark.sparkContext.setLogLevel(log_level)
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the SQL and streaming-state settings to an existing session."""
    for key, value in {**SQL_SETTINGS, **STREAM_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def _scratch_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_folder()
    return f"{root.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder given by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary folder;
    on a cluster a machine-local folder would vanish with its machine, so that is
    refused.
    """
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once nothing reads them any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    The stored table does not change between two reads, is computed once however often
    it is used, and outlives the executors that wrote it. It stays until
    :func:`clear_scratch`.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
