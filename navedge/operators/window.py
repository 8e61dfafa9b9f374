"""Sliding event-time window counts.

``F.window(ts, width, slide, offset)`` assigns each row to every window that
covers it (width / slide windows); grouping then counts per key and window.
Spark expands each row into its windows and aggregates partially before the
shuffle, so a hot key costs one partial row per task and window, and the same
expression runs unchanged in a streaming aggregation.

Panes are the tumbling windows of the greatest length that divides both width
and slide: every window is a run of whole panes. ``pane_counts`` touches each
row once, whatever width / slide is, and ``windows_of_panes`` spreads the few
summed panes over their windows. On a stream only panes are state.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navedge.schema import DEFAULT_WINDOW


def sliding_counts(df: DataFrame, ts: str, keys: list[str],
                   width: str = DEFAULT_WINDOW[0], slide: str = DEFAULT_WINDOW[1],
                   offset: str = DEFAULT_WINDOW[2]) -> DataFrame:
    """``keys..., window_start, window_end, count``; windows are [start, end)."""
    w = F.window(F.col(ts), width, slide, offset).alias("window")
    return (df.groupBy(*keys, w).agg(F.count(F.lit(1)).alias("count"))
            .select(*keys, F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "count"))


# Microseconds of the units of a day-time interval text.
_UNITS = {"microsecond": 1, "millisecond": 1000, "second": 10 ** 6, "minute": 60 * 10 ** 6, "hour": 3600 * 10 ** 6,
          "day": 86400 * 10 ** 6, "week": 7 * 86400 * 10 ** 6}


def interval_micros(text: str) -> int:
    """``10 minutes``, ``1 hour 30 minutes`` -> microseconds; months and years have no fixed length and fail."""
    parts = text.lower().removeprefix("interval ").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval of fixed length: {text!r}")
    total = 0
    for number, unit in zip(parts[::2], parts[1::2]):
        if unit.removesuffix("s") not in _UNITS:
            raise ValueError(f"not an interval of fixed length: {text!r}")
        total += int(number) * _UNITS[unit.removesuffix("s")]
    return total


def pane_of(width: str, slide: str, offset: str) -> tuple[str, str]:
    """(length, offset) of the panes of a sliding window."""
    w, s, o = (interval_micros(t) for t in (width, slide, offset))
    if not 0 < s <= w:
        raise ValueError("the slide must be positive and not above the width")
    pane = math.gcd(w, s)
    return f"{pane} microseconds", f"{o % pane} microseconds"


def pane_counts(df: DataFrame, ts: str, keys: list[str], width: str = DEFAULT_WINDOW[0], slide: str = DEFAULT_WINDOW[1],
                offset: str = DEFAULT_WINDOW[2]) -> DataFrame:
    """``keys..., pane_start, count``: rows per key and pane; each row belongs to one pane."""
    length, start = pane_of(width, slide, offset)
    w = F.window(F.col(ts), length, length, start).alias("pane")
    return (df.groupBy(*keys, w).agg(F.count(F.lit(1)).alias("count"))
            .select(*keys, F.col("pane.start").alias("pane_start"), "count"))


def windows_of_panes(panes: DataFrame, keys: list[str], width: str = DEFAULT_WINDOW[0], slide: str = DEFAULT_WINDOW[1],
                     offset: str = DEFAULT_WINDOW[2]) -> DataFrame:
    """Window counts from pane counts: the windows over a pane are those over its start, as no pane crosses a window's end."""
    w = F.window(F.col("pane_start"), width, slide, offset).alias("window")
    return (panes.groupBy(*keys, w).agg(F.sum("count").alias("count"))
            .select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "count"))


def sliding_counts_by_panes(df: DataFrame, ts: str, keys: list[str], width: str = DEFAULT_WINDOW[0],
                            slide: str = DEFAULT_WINDOW[1], offset: str = DEFAULT_WINDOW[2]) -> DataFrame:
    """``sliding_counts`` by way of panes."""
    return windows_of_panes(pane_counts(df, ts, keys, width, slide, offset), keys, width, slide, offset)
