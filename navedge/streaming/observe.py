"""What a stream did with its messages, batch by batch.

``observed_messages`` parses like ``parse_messages`` and counts, inside the
running plan (``DataFrame.observe``, no extra pass), how many messages came,
how many were kept or dropped and how many fields are null.
``ProgressTable`` is a listener that writes these counts, with the rows and
times of each batch, to a folder named by the batch: a batch that runs again
overwrites its row.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from navedge import schema as S
from navedge.streaming.engine import parse_messages

RECEIVED, PARSED = "navedge_received", "navedge_parsed"
PROGRESS_SCHEMA = ("query string, run_id string, batch_id long, started string, input_rows long, rows_per_second double, "
                   "duration_ms long, state_rows long, received long, kept long, dropped long, "
                   + ", ".join(f"null_{c} long" for c in S.EDGE_COLUMNS))


def observed_messages(raw: DataFrame, fmt: str = "tab", strict: bool = False, column: str = "value", escaped: bool = False) -> DataFrame:
    """``parse_messages`` with counts of what came in and what came out."""
    counted = raw.observe(RECEIVED, F.count(F.lit(1)).alias("received"))
    rows = parse_messages(counted, fmt, strict, column, escaped)
    return rows.observe(PARSED, F.count(F.lit(1)).alias("kept"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in S.EDGE_COLUMNS])


def _counts(observed) -> dict:
    """Values of the observations of one progress report, as plain numbers."""
    out: dict = {}
    for name in (RECEIVED, PARSED):
        row = observed.get(name)
        if row is not None:
            out.update(row.asDict())
    return out


class ProgressTable(StreamingQueryListener):
    """Writes a row for every batch of the session's streams (or of those named) under ``path``."""

    def __init__(self, spark: SparkSession, path: str, names: list[str] | None = None):
        self.spark, self.path, self.names = spark, path.rstrip("/"), names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.names is not None and p.name not in self.names:
            return
        c = _counts(p.observedMetrics)
        received, kept = c.get("received"), c.get("kept")
        row = (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond), p.durationMs.get("triggerExecution"),
               sum(o.numRowsTotal for o in p.stateOperators), received, kept, None if received is None or kept is None else received - kept,
               *(c.get(f"null_{x}") for x in S.EDGE_COLUMNS))
        folder = f"{self.path}/{json.dumps(p.name or str(p.id))[1:-1].replace('/', '_')}/batch_id={p.batchId}"
        self.spark.createDataFrame([row], PROGRESS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(folder)


def read_progress(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The progress rows of one query."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(f"{path.rstrip('/')}/{name}/*")
