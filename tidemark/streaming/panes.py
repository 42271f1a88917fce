"""Windows of a stream, over closed panes or over readings, from one state row for many stations."""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.schemas import STATION_KEY

# Executors get this module with each task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Groups that the stations are dealt to.
GROUPS = 256
#: Panes whose windows are worked out at once, beside those of one station.
AT_ONCE = 50_000
PANE = {STATION_KEY: "string", "pane_end": "bigint", "n": "bigint", "c": "bigint",
        "mean": "double", "m2": "double"}
WINDOW = ", ".join(f"{c} {kind}" for c, kind in {**PANE, "window_end": "bigint"}.items() if c != "pane_end")


def later_ends(size: int, slide: int) -> np.ndarray:
    """How long after a pane's end the windows over it end, ascending."""
    return np.arange(size // slide) * slide + size % slide


def merge_panes(panes: pd.DataFrame, size: int, slide: int, after: int, until: int) -> Iterator[pd.DataFrame]:
    """Count, mean and squares about the mean of each station's windows that end after ``after``
    and not after ``until``, all in microseconds."""
    code, names = pd.factorize(panes[STATION_KEY])
    order = np.lexsort((panes["pane_end"], code))
    code, panes = code[order], panes.iloc[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    cuts = [*first[np.diff(first // AT_ONCE, prepend=-1) > 0], len(code)]
    more = later_ends(size, slide)
    for a, b in zip(cuts, cuts[1:]):
        part = panes.iloc[a:b]
        ends = part["pane_end"].to_numpy()[:, None] + more
        row, at = np.nonzero((ends > after) & (ends <= until))
        if not len(row):
            continue
        # Sums go by time, so that they do not depend on the order of arrival.
        end, station = ends[row, at], code[a:b][row]
        by = np.lexsort((row, end, station))
        row, end, station = row[by], end[by], station[by]
        new = (np.diff(station, prepend=-1) != 0) | (np.diff(end, prepend=end[0]) != 0)
        start, group = np.flatnonzero(new), np.cumsum(new) - 1
        n, c, mean, m2 = (part[x].to_numpy()[row] for x in ("n", "c", "mean", "m2"))
        near = mean[start]
        near = np.where(np.isfinite(near), near, 0.0)
        with np.errstate(all="ignore"):
            total = np.add.reduceat(c, start)
            about = np.where(c > 0, c * (mean - near[group]), 0.0)
            middle = near + np.add.reduceat(about, start) / np.maximum(total, 1)
            apart = np.where(c > 0, c * (mean - middle[group]) ** 2, 0.0)
            squares = np.add.reduceat(m2 + apart, start)
        yield pd.DataFrame({
            STATION_KEY: names.take(station[start]), "n": np.add.reduceat(n, start), "c": total,
            "mean": middle, "m2": squares, "window_end": end[start],
        })


class PaneWindows(StatefulProcessor):
    """Keeps a group's panes until the watermark has passed all windows over them."""

    def __init__(self, size: int, slide: int) -> None:
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = ", ".join(f"{c} array<{kind}>" for c, kind in PANE.items())
        self.held = handle.getValueState("held", f"done bigint, {lists}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._closed(timerValues, [r[[*PANE]] for r in rows])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._closed(timerValues, [])

    def _closed(self, timerValues, panes: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Windows that the watermark has passed since the group was last looked at."""
        until, done, state = timerValues.getCurrentWatermarkInMs() * 1000, 0, self.held.get()
        if not panes and (state is None or state[0] >= until):
            return
        if state is not None:
            done, *lists = state
            panes = [pd.DataFrame(dict(zip(PANE, lists))), *panes]
        every = pd.concat(panes, ignore_index=True)
        yield from merge_panes(every, self.size, self.slide, done, until)
        ends = every["pane_end"].to_numpy()[:, None] + later_ends(self.size, self.slide)
        kept = every[ends[:, -1] > until]
        if kept.empty:
            self.held.clear()
            return
        self.held.update((until, *(kept[c].tolist() for c in PANE)))
        self.handle.registerTimer(int(-(-ends[ends > until].min() // 1000)))

    def close(self) -> None:
        pass


def merge_windows(parts: list[pd.DataFrame]) -> pd.DataFrame:
    """Partial results of windows, merged to one row for each station and window."""
    every = pd.concat(parts, ignore_index=True).rename(columns={"window_end": "pane_end"})
    ends = every["pane_end"]
    return pd.concat(merge_panes(every, 1, 1, ends.min() - 1, ends.max()), ignore_index=True)


def partial_windows(readings: Iterator[pd.DataFrame]) -> list[pd.DataFrame]:
    """Readings in their windows as partial results, merged whenever they have grown to twice
    their size, so that a hot station takes no more room than its windows."""
    parts, size, limit = [], 0, AT_ONCE
    for rows in readings:
        value = rows["value"].to_numpy(dtype=float)
        known = ~np.isnan(value)
        parts.append(pd.DataFrame({
            STATION_KEY: rows[STATION_KEY], "n": 1, "c": known.astype(np.int64),
            "mean": np.where(known, value, 0.0), "m2": 0.0, "window_end": rows["window_end"]}))
        size += len(rows)
        if size >= limit:
            parts = [merge_windows(parts)]
            size = len(parts[0])
            limit = 2 * size + AT_ONCE
    return parts


class ReadingWindows(StatefulProcessor):
    """Keeps a group's windows, as one value, until the watermark passes them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "done bigint, windows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._closed(timerValues, partial_windows(rows))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._closed(timerValues, [])

    def _closed(self, timerValues, parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        until, state = timerValues.getCurrentWatermarkInMs() * 1000, self.held.get()
        if not parts and (state is None or state[0] >= until):
            return
        if state is not None:
            parts = [pa.ipc.open_stream(bytes(state[1])).read_pandas(), *parts]
        every = merge_windows(parts)
        closed = every["window_end"] <= until
        if closed.any():
            yield every[closed]
        kept = every[~closed]
        if kept.empty:
            self.held.clear()
            return
        table, sink = pa.Table.from_pandas(kept, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.held.update((until, sink.getvalue().to_pybytes()))
        self.handle.registerTimer(int(-(-kept["window_end"].min() // 1000)))

    def close(self) -> None:
        pass


def _with_window(merged: DataFrame, size: int) -> DataFrame:
    end = F.col("window_end")
    return merged.withColumn("window", F.struct(
        F.timestamp_micros(end - size).alias("start"), F.timestamp_micros(end).alias("end")))


def _group() -> Column:
    return F.pmod(F.xxhash64(STATION_KEY), F.lit(GROUPS)).alias("of")


def windows_of_readings(readings: DataFrame, size: str, slide: str) -> DataFrame:
    """Windows of a stream's readings (with a watermark on ``dateTime``), each put out once the
    watermark passes it.

    Stations are dealt to groups by a hash. State is read and written once for each group in a
    micro-batch, and not once for each window. A late reading is dropped from the windows that
    the watermark has passed and counts in the others: ``at`` carries the watermark, for Spark to
    compare it.
    """
    rows = readings.select(STATION_KEY, "value", F.window("dateTime", size, slide)).select(
        _group(), STATION_KEY, "value", F.unix_micros("window.end").alias("window_end"),
        F.window_time("window").alias("at"))
    merged = rows.groupBy("of").transformWithStateInPandas(
        ReadingWindows(), WINDOW, "Append", "EventTime")
    return _with_window(merged, pd.Timedelta(size).value // 1000)


def windows_of_panes(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Windows over the closed ``pane``s of a stream, each put out once the watermark passes it.

    Stations are dealt to groups by a hash. A group keeps the panes of the last window's length,
    so state is written once for each group in a micro-batch, and not once for each window.
    """
    micros = {"size": pd.Timedelta(size).value // 1000, "slide": pd.Timedelta(slide).value // 1000}
    rows = panes.select(
        _group(), STATION_KEY, F.unix_micros("pane.end").alias("pane_end"), "n", "c", "mean", "m2")
    merged = rows.groupBy("of").transformWithStateInPandas(
        PaneWindows(**micros), WINDOW, "Append", "EventTime")
    return _with_window(merged, micros["size"])
