"""Event codecs, windows and the alert stream."""
