"""Every operator as a runnable query over the shared test tables, with the SQL that
gives the same answer."""

from tidemark.catalog import alerts, baselines, cleaning, files, messages, schedules, summaries
from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "alerts", "baselines", "cleaning", "files", "messages", "schedules",
    "summaries",
]
