"""Helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navedge.session import scratch_path

#: Rows that Spark hands to Python at a time, and bytes of texts that a pass works on at a time.
BATCH_ROWS = 1000
SLICE_BYTES = 4 << 20
#: Rows that a checked broadcast may hold; beyond it the same join shuffles.
BROADCAST_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, partitions: int | None = None, **options: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    running the steps before it again.
    """
    path = write_scratch(df, name, partitions, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_scratch(df: DataFrame, name: str, partitions: int | None = None, **options: str) -> str:
    path = scratch_path(df.sparkSession, name)
    if partitions:
        df = df.coalesce(partitions)
    df.write.options(**options).parquet(path)
    return path


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it counts at most ``limit`` rows; else as it is.

    Call it on staged frames, whose count costs a scan of footers.
    """
    return F.broadcast(df) if df.count() <= limit else df


def bound_batches(spark: SparkSession) -> None:
    """Lower Spark's 10,000 rows a batch, too many for texts of any length; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """Return memory that earlier work of this worker has freed: Spark uses a worker for one stage after another."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def slices(batches, size_of: str = "text", most: int = SLICE_BYTES):
    """The record batches in parts of about ``most`` bytes of one column, one row at least: memory doesn't grow with a batch."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(size_of)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // most
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def sheltered(docs: DataFrame, work) -> DataFrame:
    """``work(docs)`` with columns of ``docs`` that begin like this package's own (``_nv_``) renamed on the way."""
    away = {c: f"kept{i}{c}" for i, c in enumerate(docs.columns) if c.lower().startswith("_nv_")}
    if not away:
        return work(docs)
    return work(docs.withColumnsRenamed(away)).withColumnsRenamed({new: old for old, new in away.items()})
