"""Date functions."""

from pyspark.sql import Column, functions as F


def reading_date(moment: Column) -> Column:
    """Calendar day of a timestamp or ISO text; NULL for malformed text.

    Text with a zone or an offset is an instant and has its day in the session's zone (UTC,
    see :mod:`tidemark.session`); text without one keeps the day it spells.
    """
    return moment.try_cast("timestamp").cast("date")


def iso_date(day: Column) -> Column:
    """A date as ``yyyy-MM-dd`` text."""
    return F.date_format(day, "yyyy-MM-dd")


def days_from(start: Column, n_days: Column) -> Column:
    """Array of the ``n_days`` consecutive days that begin at ``start``.

    Lengths below one give an empty array (a plain ``sequence`` would count down).
    """
    return F.when(n_days >= 1, F.sequence(start, F.date_add(start, n_days - 1))).otherwise(
        F.array().cast("array<date>")
    )
