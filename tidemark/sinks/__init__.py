"""Batch sinks; the streaming sinks are in ``tidemark.streaming.alerts``."""
