"""Replay-safe tables written per micro-batch.

A streaming query may hand the same ``batch_id`` to ``foreachBatch`` again
after a failure. Every write here goes to a directory named by the batch id
and overwrites it, so a replay rewrites the same files instead of appending
twice.

* snapshot table: the whole answer of each batch (complete-mode output);
  readers take the last committed batch, that one folder only.
* change log: only the rows a batch changed (update-mode output); readers
  take each key's row from its highest batch id. Writes cost what changed,
  not the table size.

A batch is published by a marker, an empty file under ``_commits`` whose name
is the batch id: it is written after the data, so readers never see a batch half written, and an empty newest answer
counts as the newest. ``compact_log`` folds all committed batches up to one
into a base next to them; readers then start at the latest base, and
``trim_log`` removes what it covers. Both can run while the stream writes
later batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navedge.operators.keyed import latest_per_key

VERSION = "batch_id"


def _hadoop(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, location = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(location)] if fs.exists(location) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _hadoop(spark, path)
    return fs.exists(location)


def _mark(spark: SparkSession, path: str, kind: str, batch_id: int) -> None:
    fs, location = _hadoop(spark, f"{path.rstrip('/')}/{kind}/{int(batch_id)}")
    fs.create(location, True).close()


def committed(spark: SparkSession, path: str, kind: str = "_commits") -> list[int]:
    """Published batch ids (``_bases``: ids up to which a base exists), ascending."""
    return sorted(int(n) for n in _names(spark, f"{path.rstrip('/')}/{kind}") if n.isdigit())


def write_version(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", commit: bool = True) -> None:
    df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{VERSION}={int(batch_id)}")
    if commit:
        _mark(df.sparkSession, path, "_commits", batch_id)


def publish(spark: SparkSession, root: str, batch_id: int) -> None:
    """Publish a batch of several sinks under ``root``, after every one of them was written."""
    _mark(spark, root, "_commits", batch_id)


def published_folders(spark: SparkSession, root: str, leg: str) -> list[str]:
    """Folders of one sink of the published batches."""
    return [f"{root.rstrip('/')}/{leg}/{VERSION}={i}" for i in committed(spark, root)]


def _folder(spark: SparkSession, path: str, name: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{name}").withColumn(VERSION, F.lit(int(batch_id)).cast("bigint"))


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all committed batches, with their ``batch_id``; folded batches come from the latest base."""
    ids, bases = committed(spark, path), committed(spark, path, "_bases")
    base = bases[-1] if bases else None
    tail = [i for i in ids if base is None or i > base]
    if base is None and not tail:
        raise FileNotFoundError(f"no committed batch under {path}")
    root = path.rstrip("/")
    out = None if base is None else _folder(spark, path, f"base={base}", base)
    if tail:
        # One scan for all batches: the id is the folder's name.
        rows = spark.read.option("basePath", root).parquet(*[f"{root}/{VERSION}={i}" for i in tail])
        rows = rows.withColumn(VERSION, F.col(VERSION).cast("bigint"))
        out = rows if out is None else out.unionByName(rows)
    return out


def read_latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    ids = committed(spark, path)
    if not ids:
        raise FileNotFoundError(f"no committed batch under {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{VERSION}={ids[-1]}")


def read_latest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    return latest_per_key(read_versions(spark, path), keys, VERSION)


def compact_log(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Fold the committed batches into a base; returns the id it reaches. Older folders may then be deleted."""
    last = committed(spark, path)[-1]
    read_latest_per_key(spark, path, keys).write.mode("overwrite").parquet(f"{path.rstrip('/')}/base={last}")
    _mark(spark, path, "_bases", last)
    return last


def trim_log(spark: SparkSession, path: str) -> int:
    """Delete the folders and markers that the latest base covers, and older bases; returns the folders deleted.

    Readers that started before the base was published may still list them:
    run it a while after ``compact_log``, or when no reader is that old.
    """
    bases, root = committed(spark, path, "_bases"), path.rstrip("/")
    if not bases:
        return 0
    gone = 0

    def delete(name: str) -> None:
        fs, location = _hadoop(spark, f"{root}/{name}")
        fs.delete(location, True)

    for folder in _names(spark, root):
        kind, _, number = folder.partition("=")
        if number.isdigit() and (kind == VERSION and int(number) <= bases[-1] or kind == "base" and int(number) < bases[-1]):
            delete(folder)
            gone += 1
    # The newest marker stays: snapshots and commands ask for the last batch.
    for i in committed(spark, path):
        if i < bases[-1]:
            delete(f"_commits/{i}")
    for i in bases[:-1]:
        delete(f"_bases/{i}")
    return gone
