"""Cleaning and shaping of raw readings."""

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import calendar, text
from tidemark.schemas import STATION_KEY


def select_reading(df: DataFrame) -> DataFrame:
    """The three columns the batch job uses."""
    return df.select("dateTime", "measure", "value")


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def filter_parameter(df: DataFrame, parameter: str = "level") -> DataFrame:
    """Keep one measured parameter; rows without a parameter go too."""
    return df.where(F.col("parameter") == parameter)


def clean_first_number(df: DataFrame) -> DataFrame:
    """Replace the text ``value`` by its first number; drop rows that have none."""
    raw = F.col("value")
    number = text.blank_to_null_double(text.first_number(raw))
    return df.where(text.holds_number(raw)).withColumn("value", number)


def clean_strict_number(df: DataFrame) -> DataFrame:
    """Replace the text ``value`` by its number; drop rows that are not one number."""
    return drop_null(df.withColumn("value", text.strict_double(F.col("value"))), "value")


def with_keys(df: DataFrame, require_station: bool = True) -> DataFrame:
    """Add the station id and the calendar day.

    Ids outside the accepted pattern come out empty and would pool into one nameless
    station; ``require_station`` drops those rows.
    """
    keyed = df.withColumns(
        {
            STATION_KEY: text.station_ref(F.col("measure")),
            "reading_date": calendar.reading_date(F.col("dateTime")),
        }
    )
    if not require_station:
        return keyed
    return keyed.where(F.nullif(F.col(STATION_KEY), F.lit("")).isNotNull())


def clean_readings(
    df: DataFrame, parameter: str | None = None, require_station: bool = True
) -> DataFrame:
    """Raw readings to numeric readings with station id and day."""
    if parameter is not None:
        df = filter_parameter(df, parameter)
    return with_keys(clean_first_number(select_reading(df)), require_station)
