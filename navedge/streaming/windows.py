"""Sliding-window counts on a stream.

The same ``sliding_counts`` expression as in batch, over a streaming frame,
in update mode: each micro-batch emits only the windows it changed, into a
change log keyed by ``(keys, window_start, window_end)``. An optional
watermark (event time must be ``TIMESTAMP``; ``TIMESTAMP_NTZ`` is cast in the
session time zone) lets Spark drop the state of closed windows; events behind
the watermark are then dropped, so files or partitions must arrive roughly in
event-time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navedge.operators.window import pane_counts, sliding_counts, windows_of_panes
from navedge.schema import DEFAULT_WINDOW
from navedge.sinks.versioned import read_latest_per_key
from navedge.streaming.engine import run_change_log


def window_count_stream(events: DataFrame, ts: str, keys: list[str],
                        width: str = DEFAULT_WINDOW[0], slide: str = DEFAULT_WINDOW[1],
                        offset: str = DEFAULT_WINDOW[2], watermark: str | None = None
                        ) -> DataFrame:
    return sliding_counts(_watermarked(events, ts, watermark), ts, keys, width, slide, offset)


def _watermarked(events: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    if not watermark:
        # TIMESTAMP_NTZ is kept, so the windows do not depend on the session time zone
        return events
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)  # watermarks need TIMESTAMP


def run_window_counts(events: DataFrame, ts: str, keys: list[str], watermark: str | None = None,
                      path: str | None = None, checkpoint: str | None = None,
                      trigger: str | None = "availableNow", **window):
    return run_change_log(window_count_stream(events, ts, keys, watermark=watermark, **window),
                          path, checkpoint, trigger, None)


def run_pane_counts(events: DataFrame, ts: str, keys: list[str], watermark: str | None = None,
                    path: str | None = None, checkpoint: str | None = None,
                    trigger: str | None = "availableNow", **window):
    """Counts per key and pane as the only state, so an event updates one state row instead of width / slide;
    changed panes go to the change log, and ``current_windows`` assembles the windows."""
    return run_change_log(pane_counts(_watermarked(events, ts, watermark), ts, keys, **window), path, checkpoint, trigger, None)


def current_windows(spark, change_log: str, keys: list[str], **window) -> DataFrame:
    """Window counts from the change log of ``run_pane_counts`` (started with the same window)."""
    return windows_of_panes(read_latest_per_key(spark, change_log, [*keys, "pane_start"]), keys, **window)
