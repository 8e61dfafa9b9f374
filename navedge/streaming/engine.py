"""Structured Streaming over click messages.

One stateful query serves many answers: the stream is parsed and summed per
edge ``(prev, curr, type)`` once; every answer (questions 1-9, totals) is a
batch function of that edge table, applied inside ``foreachBatch``. This
replaces one stateful query (and one read of the topic) per question, and it
is also the only legal form of the questions Spark refuses on a stream
(joins of two streaming aggregates, sorts without aggregation, unions).

Routes for the edge state:

* complete mode: each batch sees the whole edge table; answers are written
  as versioned snapshots. For a modest number of edges.
* update mode: each batch sees only the edges it changed. They go to a change
  log, where the edge table is each key's latest row and writes cost what
  changed; or into a stored table by key, which rewrites the buckets they
  touch and leaves readers nothing to fold.
* no output: answers are read from the state in the checkpoint, as of any
  batch that it still holds.

Aggregation state is kept by the RocksDB provider in all of them.

Every sink is keyed by ``batch_id`` and overwritten on replay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from navedge import schema as S
from navedge.functions.parse import parse_json, parse_permissive, parse_strict
from navedge.session import scratch_path
from navedge.sources.files import read_csv_lines, write_csv, write_csv_lines
from navedge.sinks.table import BUCKETS, replace_batch
from navedge.sinks.versioned import (VERSION, publish, published_folders, read_latest_per_key,
                                     read_latest_snapshot, write_version)

Answer = Callable[[DataFrame], DataFrame]


# Parsing and state -----------------------------------------------------------
def parse_messages(raw: DataFrame, fmt: str = "tab", strict: bool = False,
                   column: str = "value", escaped: bool = False) -> DataFrame:
    """Edge rows from a message stream (Kafka ``value`` bytes or text lines; ``escaped``: see ``escape_field``)."""
    if fmt == "json":
        return parse_json(raw, column, strict=strict)
    if strict:
        return parse_strict(raw, column, escaped=escaped)
    return parse_permissive(raw, column, escaped=escaped)


def edge_totals(edges: DataFrame) -> DataFrame:
    """The single stateful aggregation: hits summed per edge."""
    return edges.groupBy(*S.KEY_COLUMNS).agg(F.sum(S.N).cast("bigint").alias(S.N))


# Running ---------------------------------------------------------------------
def _start(df: DataFrame, handler, mode: str, checkpoint: str,
           trigger: str | None, name: str | None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger in (None, "availableNow"):
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.foreachBatch(handler).start()


def await_done(query: StreamingQuery, timeout_sec: float | None = None) -> StreamingQuery:
    """Wait for a query (PySpark timeouts are seconds); re-raise its failure."""
    if timeout_sec is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_sec)
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def answers_handler(answers: dict[str, Answer], out_root: str, table_write=None):
    """``foreachBatch`` body: each answer of the batch frame, one snapshot each; ``table_write(name)`` gives a function
    of (answer, batch id) that puts the snapshot into a relational table."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, fn in answers.items():
                write_version(fn(batch), f"{out_root}/{name}", batch_id, commit=True)
                if table_write is not None:  # the answer as written, not computed again
                    table_write(name)(read_latest_snapshot(batch.sparkSession, f"{out_root}/{name}"), batch_id)
        finally:
            batch.unpersist()
    return handle


def change_log_handler(path: str):
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, path, batch_id, commit=True)
    return handle


def run_answers(edge_state: DataFrame, answers: dict[str, Answer], out_root: str | None = None,
                checkpoint: str | None = None, trigger: str | None = "availableNow",
                name: str | None = None, table_write=None) -> tuple[StreamingQuery, str]:
    """Complete-mode edge state; answers written as snapshots under ``out_root`` (and to tables, see ``answers_handler``)."""
    spark = edge_state.sparkSession
    out_root = out_root or scratch_path(spark, "answers")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name or 'answers'}")
    q = _start(edge_state, answers_handler(answers, out_root, table_write), "complete", checkpoint, trigger, name)
    return q, out_root


def run_change_log(aggregated: DataFrame, path: str | None = None, checkpoint: str | None = None,
                   trigger: str | None = "availableNow", name: str | None = None
                   ) -> tuple[StreamingQuery, str]:
    """Update-mode aggregate; changed rows written to a change log at ``path``."""
    spark = aggregated.sparkSession
    path = path or scratch_path(spark, "changes")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name or 'changes'}")
    q = _start(aggregated, change_log_handler(path), "update", checkpoint, trigger, name)
    return q, path


def table_handler(path: str, keys: list[str], buckets: int):
    def handle(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch, path, batch_id, keys, buckets)
    return handle


def run_table(aggregated: DataFrame, keys: list[str], path: str | None = None, checkpoint: str | None = None,
              trigger: str | None = "availableNow", name: str | None = None, buckets: int = BUCKETS
              ) -> tuple[StreamingQuery, str]:
    """Update-mode aggregate replaced by key into a stored table, so readers fold nothing."""
    spark = aggregated.sparkSession
    path = path or scratch_path(spark, "table")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name or 'table'}")
    q = _start(aggregated, table_handler(path, keys, buckets), "update", checkpoint, trigger, name)
    return q, path


def run_state_only(aggregated: DataFrame, checkpoint: str | None = None, trigger: str | None = "availableNow",
                   name: str | None = None) -> tuple[StreamingQuery, str]:
    """Keep the aggregate as state and write no output; ``state_edges`` reads it from the checkpoint."""
    checkpoint = checkpoint or scratch_path(aggregated.sparkSession, f"ckpt-{name or 'state'}")
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("noop").mode("overwrite").save()  # what is not computed never reaches the state
    return _start(aggregated, handle, "update", checkpoint, trigger, name), checkpoint


def run_append(rows: DataFrame, path: str | None = None, checkpoint: str | None = None,
               trigger: str | None = "availableNow", name: str | None = None,
               fmt: str = "parquet") -> tuple[StreamingQuery, str]:
    """Append stream into the built-in file sink (exactly-once via its log)."""
    spark = rows.sparkSession
    path = path or scratch_path(spark, "append")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name or 'append'}")
    w = (rows.writeStream.outputMode("append").format(fmt)
         .option("path", path).option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if trigger in (None, "availableNow") else w.trigger(processingTime=trigger)
    return w.start(), path


def fanout_handler(csv_path: str, parquet_path: str, jdbc_write=None):
    """Persist a micro-batch once, write it to every sink, release it."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_csv(batch, f"{csv_path.rstrip('/')}/batch_id={int(batch_id)}")
            write_version(batch, parquet_path, batch_id, commit=True)
            if jdbc_write is not None:
                jdbc_write(batch, batch_id)
        finally:
            batch.unpersist()
    return handle


def run_fanout(rows: DataFrame, csv_path: str | None = None, parquet_path: str | None = None,
               jdbc_write=None, checkpoint: str | None = None,
               trigger: str | None = "availableNow") -> tuple[StreamingQuery, str, str]:
    spark = rows.sparkSession
    csv_path = csv_path or scratch_path(spark, "fanout-csv")
    parquet_path = parquet_path or scratch_path(spark, "fanout-parquet")
    checkpoint = checkpoint or scratch_path(spark, "ckpt-fanout")
    q = _start(rows, fanout_handler(csv_path, parquet_path, jdbc_write), "append",
               checkpoint, trigger, None)
    return q, csv_path, parquet_path


ANSWERS, CSV, PARQUET = "answers", "csv", "parquet"


def legs_handler(root: str, answers: dict[str, Answer] | None = None, jdbc_write=None):
    """A ``foreachBatch`` function whose sinks are published together: the rows as CSV lines and Parquet, answers over
    the batch, a table. Readers (``read_leg``) follow the one marker that is written last, so none sees a batch that
    another sink doesn't have, and a batch that failed between two sinks is not there."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_csv_lines(batch, f"{root}/{CSV}/{VERSION}={int(batch_id)}")
            write_version(batch, f"{root}/{PARQUET}", batch_id, commit=False)
            for name, fn in (answers or {}).items():
                write_version(fn(batch), f"{root}/{ANSWERS}/{name}", batch_id, commit=False)
            if jdbc_write is not None:
                jdbc_write(batch, batch_id)
            publish(batch.sparkSession, root, batch_id)
        finally:
            batch.unpersist()
    return handle


def run_legs(rows: DataFrame, root: str | None = None, answers: dict[str, Answer] | None = None, jdbc_write=None,
             checkpoint: str | None = None, trigger: str | None = "availableNow") -> tuple[StreamingQuery, str]:
    spark = rows.sparkSession
    root = (root or scratch_path(spark, "legs")).rstrip("/")
    q = _start(rows, legs_handler(root, answers, jdbc_write), "append", checkpoint or scratch_path(spark, "ckpt-legs"), trigger, None)
    return q, root


def read_leg(spark: SparkSession, root: str, leg: str, schema=S.EDGE_SCHEMA) -> DataFrame:
    """Rows of the published batches from one sink: ``csv``, ``parquet`` or ``answers/<name>`` (each batch's answer)."""
    folders = published_folders(spark, root, leg)
    if not folders:
        return spark.createDataFrame([], schema)
    return read_csv_lines(spark, folders, schema) if leg == CSV else spark.read.parquet(*folders)


def run_console(df: DataFrame, mode: str = "append", truncate: bool = False,
                trigger: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Print each micro-batch (``format("console")``), for inspection only."""
    w = df.writeStream.format("console").outputMode(mode).option("truncate", str(truncate).lower())
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger and trigger != "availableNow":
        w = w.trigger(processingTime=trigger)
    elif trigger == "availableNow":
        w = w.trigger(availableNow=True)
    return w.start()


def await_any(spark: SparkSession, timeout_sec: float | None = None) -> bool | None:
    """Wait until any query of the session ends, or for the timeout; a failed query raises."""
    return spark.streams.awaitAnyTermination() if timeout_sec is None else spark.streams.awaitAnyTermination(timeout_sec)


# Reading results back --------------------------------------------------------
def latest_answer(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    return read_latest_snapshot(spark, f"{out_root}/{name}")


def current_edges(spark: SparkSession, change_log: str) -> DataFrame:
    return read_latest_per_key(spark, change_log, S.KEY_COLUMNS).select(*S.EDGE_COLUMNS)


def read_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0) -> DataFrame:
    """The rows of a grouped stream's state, key and value columns side by side, after a batch (default: the last).

    The state of a checkpoint is a table of its own, so answers need neither
    complete mode nor a log of changes; the stream may be running or stopped.
    """
    r = spark.read.format("statestore").option("operatorId", str(operator))
    if batch_id is not None:
        r = r.option("batchId", str(int(batch_id)))
    return r.load(checkpoint).select("key.*", "value.*")


def state_edges(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The edge table held by the state of ``edge_totals``."""
    state = read_state(spark, checkpoint, batch_id)
    hits = next(c for c in state.columns if c not in S.KEY_COLUMNS)
    return state.select(*S.KEY_COLUMNS, F.col(hits).cast("bigint").alias(S.N))
