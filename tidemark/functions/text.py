"""Text functions: pull numbers and station ids out of messy strings."""

from pyspark.sql import Column, functions as F

# Patterns that define which text counts as a number or a station id.
FIRST_NUMBER_PATTERN = r"(-?\d+(\.\d+)?)"
STRICT_NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
STATION_PATTERN = r"/id/measures/([0-9A-Z]+)-"
FILE_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"


def first_number(text: Column) -> Column:
    """First signed decimal in the text; empty text when there is none."""
    return F.regexp_extract(text, FIRST_NUMBER_PATTERN, 0)


def holds_number(text: Column) -> Column:
    """True when :func:`first_number` finds something.

    A match always contains a digit and any digit is a match, so looking for one
    digit replaces a second run of the full pattern in filters.
    """
    return text.rlike("[0-9]")


def blank_to_null_double(text: Column) -> Column:
    """Empty text becomes NULL, the rest a double."""
    return F.nullif(text, F.lit("")).cast("double")


def strict_double(text: Column) -> Column:
    """The text as a double when all of it is a finite decimal number, else NULL.

    The pattern guards the cast: Spark alone would accept ``5d``, ``NaN`` and
    ``Infinity``. A number too large for a double overflows and counts as no number.
    """
    number = F.when(text.rlike(STRICT_NUMBER_PATTERN), text.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def station_ref(measure: Column) -> Column:
    """Station id inside a measure URI; empty text when the URI has none."""
    return F.regexp_extract(measure, STATION_PATTERN, 1)


def station_code(number: Column, prefix: str = "UK") -> Column:
    """Station code: prefix and the number padded to three digits."""
    return F.format_string(prefix + "%03d", number)


def station_name(town: Column, river: Column) -> Column:
    """Display name of a gauge; unknown parts are left out."""
    return F.concat_ws(" ", town, river, F.lit("Gauge"))


def file_date(path: Column) -> Column:
    """The date stamped into a file path, NULL when there is none."""
    return F.regexp_extract(path, FILE_DATE_PATTERN, 1).try_cast("date")
