"""File and table sinks."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.files import CSV_DIALECT


def write_curated(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a curated Parquet table.

    Rows of a partitioned table are brought together by partition first, or every task would
    write a file into every folder. The hint leaves Spark free to split a large folder's rows
    and to put small ones together.
    """
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def _one_line(name: str) -> Column:
    value = F.col(f"`{name}`")
    message = F.lit(f"a line feed in column {name}; write with multi_line")
    return F.when(value.rlike(r"[\r\n]"), F.raise_error(message)).otherwise(value).alias(name)


def write_csv(
    df: DataFrame, path: str, partition_by: str | None = None, multi_line: bool = False
) -> None:
    """Overwrite a folder of CSV files with header.

    A value with a line feed is an error unless ``multi_line``, since only a reader with the
    same option gets it back whole.
    """
    if not multi_line:
        df = df.select(*(
            _one_line(c) if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes
        ))
    writer = df.write.mode("overwrite").options(**CSV_DIALECT)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def load_table(
    spark: SparkSession,
    path: str,
    table: str,
    location: str | None = None,
    provider: str = "parquet",
    **options,
) -> DataFrame:
    """Load curated Parquet into a catalog table and return that table.

    ``location`` keeps the table's files outside the catalog's own warehouse folder.
    ``provider`` may name a warehouse connector where its jar is present.
    """
    writer = spark.read.parquet(path).write.format(provider).mode("overwrite").options(**options)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    return spark.table(table)
