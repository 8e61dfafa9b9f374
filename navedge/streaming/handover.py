"""Continue a stream with another number of state partitions.

A checkpoint fixes how many partitions its state has when the query first
starts, so a state that outgrows them can't be spread by a restart. Here a
stopped query hands over instead: its edge state, as of the last committed
batch, is written as a table (the seed), and a new query with a checkpoint of
its own reads the seed once, in its first batch, beside the messages that the
old one had not read. Edge totals are sums, so the seed's rows are added like
any others; the shuffle partitions of the new session are those of its state.

The new query's batches count from zero, so its results need folders of their
own. Starting it again with the same checkpoints changes nothing: the seed is
written once and published by its ``_SUCCESS`` file.

What the old query had read: for files, the paths in the file source's log up
to the offset of the last committed batch; the new query drops rows of those
(it lists and reads these files once more; ``since`` spares those that were
last changed before). For topics, the offsets that ``kafka_stream`` starts
from. A file that the old query had planned but not committed is read by the
new one.

Defined results: a checkpoint without a committed batch hands over nothing and
every message is read; null keys and counts are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navedge import schema as S
from navedge.sinks.versioned import committed, exists
from navedge.streaming.engine import state_edges


def last_committed(spark: SparkSession, checkpoint: str, source: int = 0) -> tuple[int, str] | None:
    """(last committed batch, offset of a source at its end as JSON text), or None if no batch was committed."""
    ids = committed(spark, checkpoint, "commits")
    if not ids:
        return None
    lines = spark.read.text(f"{checkpoint}/offsets/{ids[-1]}", wholetext=True).first()[0].split("\n")
    return ids[-1], lines[2 + source]  # a version, settings, then a line a source


def read_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(path) of the files that the committed batches of a file stream have read."""
    at = last_committed(spark, checkpoint, source)
    if at is None:
        return spark.createDataFrame([], "path string")
    log = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    entry = log.select(F.from_json("value", "path string, batchId long").alias("e"))
    offset = F.get_json_object(F.lit(at[1]), "$.logOffset").cast("long")
    return entry.where(F.col("e.batchId") <= offset).select(_path(F.col("e.path")).alias("path")).distinct()


def _path(uri):
    """One form of ``file:/a`` and ``file:///a``."""
    return F.regexp_replace(uri, "^([A-Za-z0-9+.-]+):/(//)?(?=[^/])", "$1:/")


def remaining_text(spark: SparkSession, path: str, after: str, max_files_per_trigger: int | None = None,
                   since: str | None = None) -> DataFrame:
    """``text_stream`` without the files that the stream of checkpoint ``after`` has read.

    ``since``: a time before which every file is known to be read; Spark then doesn't open older ones.
    """
    from navedge.sources.messages import text_stream
    raw = text_stream(spark, path, max_files_per_trigger)
    if since is not None:
        raw = raw.where(F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp"))
    lines = raw.select("value", _path(F.col("_metadata.file_path")).alias("path"))
    return lines.join(read_files(spark, after), "path", "left_anti").select("value")


def starting_offsets(spark: SparkSession, after: str) -> str:
    """Where a topic's new query starts: the ``startingOffsets`` text of ``kafka_options``."""
    at = last_committed(spark, after)
    return "earliest" if at is None else at[1]


def write_seed(spark: SparkSession, after: str, seed: str) -> str:
    """Write the edge state of the stopped query to ``seed``, unless a start before this one has."""
    if not exists(spark, f"{seed}/_SUCCESS"):
        at = last_committed(spark, after)
        edges = spark.createDataFrame([], S.EDGE_SCHEMA) if at is None else state_edges(spark, after, at[0])
        edges.select(*S.EDGE_COLUMNS).write.mode("overwrite").parquet(seed)
    return seed


def continued(rows: DataFrame, after: str, checkpoint: str) -> DataFrame:
    """``rows``, the messages left to read, with the state of checkpoint ``after`` before them.

    ``checkpoint`` is the new query's; the seed lies beside it.
    """
    spark = rows.sparkSession
    seed = write_seed(spark, after, f"{checkpoint.rstrip('/')}-seed")
    return rows.select(*S.EDGE_COLUMNS).unionByName(spark.readStream.schema(S.EDGE_SCHEMA).parquet(seed))
