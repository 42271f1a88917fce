"""Calendar operators: day spines and interval membership."""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import calendar
from tidemark.operators.cleaning import drop_null
from tidemark.operators.rowjoin import row_join
from tidemark.schemas import STATION_KEY


def date_spine(spark: SparkSession, start: str, n_days: int) -> DataFrame:
    """``n_days`` consecutive days from ``start``, one row each."""
    days = calendar.days_from(F.lit(start).cast("date"), F.lit(n_days))
    return spark.range(1).select(F.explode(days).alias("date"))


def station_day_spine(
    stations: DataFrame, start: str, n_days: int, partitions: int | None = None
) -> DataFrame:
    """Every station on every day.

    Each station row unrolls its own days in place, without a join. The stations are a
    small table that would mostly sit in one task, so they are spread first, over
    ``partitions`` tasks (default: the session's shuffle partitions).
    """
    if partitions is None:
        partitions = int(stations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = calendar.days_from(F.lit(start).cast("date"), F.lit(n_days))
    spread = stations.repartition(partitions, STATION_KEY)
    return spread.select("*", F.explode(days).alias("date"))


def interval_days(
    intervals: DataFrame, start: str = "start", length: str = "length"
) -> DataFrame:
    """Distinct (station, day) pairs covered by any interval ``[start, start+length)``.

    Overlapping days collapse in the partial aggregation, inside the task that unrolled
    them, so many events of one station send each day once per task.
    """
    days = calendar.days_from(F.col(start), F.col(length))
    return intervals.select(STATION_KEY, F.explode(days).alias("date")).distinct()


def flag_in_interval(
    days: DataFrame,
    intervals: DataFrame,
    start: str = "start",
    length: str = "length",
    name: str = "in_interval",
) -> DataFrame:
    """Flag each day row that lies in any interval of its station.

    An equi-join on station and day: a hot station spreads over its days, and a day is
    matched at most once however many intervals cover it.
    """
    known = drop_null(intervals, STATION_KEY)
    covered = interval_days(known, start, length).withColumn(name, F.lit(True))
    return row_join(days, covered, [STATION_KEY, "date"], "left").fillna({name: False})


#: Days of a bin. An interval takes one row for each bin that it touches.
BIN_DAYS = 32


def _bin(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BIN_DAYS)


def _islands(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans [first, after) of the same ``keys`` that touch or overlap, as one."""
    order = Window.partitionBy(*keys).orderBy("first", "after")
    reach = F.max("after").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > reach, F.lit(True)).cast("int")
    island = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = spans.withColumn("_opens", opens).withColumn("_island", island)
    return numbered.groupBy(*keys, "_island").agg(
        F.min("first").alias("first"), F.max("after").alias("after")).drop("_island")


def merge_intervals(
    intervals: DataFrame, start: str = "start", length: str = "length"
) -> DataFrame:
    """The days of each station's intervals ``[start, start + length)`` as disjoint spans
    ``[first, after)``, the longest possible.

    Gaps and islands: a span begins where no earlier one reaches. Intervals that begin in the same
    bin of days are merged first, which shrinks many overlapping intervals of one station to a
    few spans before all of them meet in the station's window. Intervals without a day, or with
    a null, are none.
    """
    first = F.col(start).cast("date")
    spans = intervals.where(F.col(length) > 0).select(
        STATION_KEY, first.alias("first"),
        F.date_add(first, F.col(length).cast("int")).alias("after"), _bin(first).alias("_bin"),
    ).where(F.col("first").isNotNull() & F.col(STATION_KEY).isNotNull())
    return _islands(_islands(spans, [STATION_KEY, "_bin"]).drop("_bin"), [STATION_KEY])


def flag_in_spans(
    days: DataFrame, spans: DataFrame, name: str = "in_interval"
) -> DataFrame:
    """Flag each day row that lies in one of its station's disjoint spans ``[first, after)``, as
    :func:`merge_intervals` gives them.

    A range join over bins of days: a span takes one row for each bin that it touches, not for
    each day, and a day meets the spans of one bin only. Spans are disjoint, so the number of
    rows stays as it is; a hot station spreads over its bins.
    """
    bins = F.sequence(_bin(F.col("first")), _bin(F.date_sub("after", 1)))
    pieces = spans.select(STATION_KEY, "first", "after", F.explode(bins).alias("_bin")).groupBy(
        STATION_KEY, "_bin").agg(F.sort_array(F.collect_list(F.struct("first", "after"))).alias("_spans"))
    day = F.col("date").cast("date")
    binned = days.withColumn("_bin", _bin(day))
    met = row_join(binned, pieces, [STATION_KEY, "_bin"], "left")
    inside = F.exists("_spans", lambda s: (s["first"] <= day) & (day < s["after"]))
    return met.withColumn(name, F.coalesce(inside, F.lit(False))).drop("_bin", "_spans")
