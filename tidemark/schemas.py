"""Declared schemas and column contracts.

Every text source is read with one of these schemas, never with inference:
inference costs a full extra pass and makes the type of ``value`` depend on
which other rows happen to share the folder.
"""

from pyspark.sql import types as T


def _struct(columns: str) -> T.StructType:
    """Nullable fields from ``name TYPE, ...`` text, without needing a session yet."""
    schema = T.StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, kind.lower())
    return schema


# Column names and types of the exchanged data.
READINGS = _struct("dateTime STRING, measure STRING, value STRING")

ARCHIVE_ROW = _struct(
    "dateTime STRING, date STRING, measure STRING, value STRING, parameter STRING, "
    "stationReference STRING, label STRING, unitName STRING, valueType STRING, datumType STRING"
)

STATIONS = _struct(
    "stationReference STRING, label STRING, riverName STRING, catchmentName STRING, "
    "town STRING, lat DOUBLE, long DOUBLE, status STRING"
)

EVENT_SCHEMA = _struct(
    "stationReference STRING, dateTime TIMESTAMP, value DOUBLE, measure STRING, "
    "stationName STRING, riverName STRING, catchmentName STRING, town STRING, "
    "lat DOUBLE, long DOUBLE"
)

# The fields of an event that window statistics use.
LEVEL_EVENT = _struct("stationReference STRING, dateTime TIMESTAMP, value DOUBLE")

STATION_METADATA = _struct(
    "stationReference STRING, stationName STRING, riverName STRING, catchmentName STRING, "
    "town STRING, lat DOUBLE, long DOUBLE, typical_range_low DOUBLE, "
    "typical_range_high DOUBLE, status STRING, alert_threshold_high DOUBLE, "
    "alert_threshold_very_high DOUBLE"
)

DAILY_RISK = _struct(
    "stationReference STRING, date STRING, level DOUBLE, typical_range_low DOUBLE, "
    "typical_range_high DOUBLE, flood_risk STRING"
)

BASELINE_VIEW_COLUMNS = [
    "stationReference", "mean_level_total", "std_level_total", "alert_threshold_high",
    "alert_threshold_very_high", "riverName", "catchmentName", "town",
]

ALERT_COLUMNS = [
    "stationReference", "window_start", "window_end", "n_readings_window",
    "mean_level_window", "std_level_window", "mean_level_total", "std_level_total",
    "z_score", "alert_level", "alert_threshold_high", "alert_threshold_very_high",
    "riverName", "catchmentName", "town",
]

STATION_KEY = "stationReference"
