"""Message streams: Kafka subscription options and a file-stream stand-in.

The Kafka source yields ``key, value, topic, partition, offset, timestamp,
timestampType``; only ``value`` is parsed. Where the Kafka connector is not
on the classpath, the same parsers run on a directory of text files read with
``readStream.text`` (one message per line, column ``value``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from navedge.functions.parse import json_message, tab_message
from navedge.session import default_parallelism, scratch_path
from navedge.sources.files import write_text

SUBSCRIPTION_KINDS = ("assign", "subscribe", "subscribePattern")


def kafka_options(bootstrap_servers: str, subscribe_type: str, topics: str,
                  starting_offsets: str = "earliest", fail_on_data_loss: bool = True,
                  max_offsets_per_trigger: int | None = None,
                  extra: dict[str, str] | None = None) -> dict[str, str]:
    """Source options for one subscription; exactly one kind is allowed. Lost offsets fail the query unless
    ``fail_on_data_loss`` is off."""
    if subscribe_type not in SUBSCRIPTION_KINDS:
        raise ValueError(f"subscribe type must be one of {SUBSCRIPTION_KINDS}, got {subscribe_type!r}")
    if not bootstrap_servers or not topics:
        raise ValueError("bootstrap servers and topics are required")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        subscribe_type: topics,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """``readStream.format("kafka")`` with the given options (needs the connector)."""
    return spark.readStream.format("kafka").options(**options).load()


def kafka_sink_options(bootstrap_servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic,
            "checkpointLocation": checkpoint}


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                path_glob: str | None = None) -> DataFrame:
    """Directory of message lines as a stream of ``value STRING``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    return r.load(path)


def stage_messages(clicks: DataFrame, fmt: str = "tab", path: str | None = None,
                   files: int | None = None, escaped: bool = True) -> str:
    """Write click rows as message lines (tab form: escaped by default) into ``files`` files (default: the
    session's parallelism).

    Round-robin, not hashed on a key: files stay equal in size even when one
    message arrives in a great many copies, and the write has as many tasks
    as any other stage whatever adaptive execution did to the input.
    """
    spark = clicks.sparkSession
    path = path or scratch_path(spark, f"messages-{fmt}")
    n = int(files or default_parallelism(spark))
    rows = clicks.repartition(n)
    if "event_id" in clicks.columns:
        rows = rows.sortWithinPartitions("event_id")
    write_text(tab_message(rows, escaped=escaped) if fmt == "tab" else json_message(rows), path)
    return path


def files_per_trigger(spark: SparkSession, path: str, batches: int) -> int:
    """``maxFilesPerTrigger`` that splits the files under ``path`` into about
    ``batches`` micro-batches (file listing only, no data read)."""
    n = len(spark.read.format("text").load(path).inputFiles())
    return max(1, -(-n // max(1, batches)))


def kafka_message_sink(edges: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                       trigger: str | None = None, mode: str = "update"):
    """Stream edge rows to a topic as ``prev:curr:type:n`` text (needs the connector).

    Spark's Kafka sink writes each partition with its own producer; a
    replayed batch may be delivered twice (at-least-once), as with any
    Kafka producer sink.
    """
    from navedge.functions.parse import encode_message
    w = (encode_message(edges).writeStream.format("kafka").outputMode(mode)
         .options(**kafka_sink_options(bootstrap_servers, topic, checkpoint)))
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def write_kafka_messages(edges: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Batch write of edge rows to a topic as ``prev:curr:type:n`` text."""
    from navedge.functions.parse import encode_message
    (encode_message(edges).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
