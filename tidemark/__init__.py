"""Sensor-level analytics as plain Spark DataFrame functions."""
