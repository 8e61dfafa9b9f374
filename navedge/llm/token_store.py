"""Token ids as Parquet list columns.

One row per document in ascending doc_id order: number columns and ``ids``,
an array of integers. Parquet's second page version writes them with delta
encoding, as the dictionary is off; row groups and pages have
set sizes, and the page indexes that Parquet-MR writes let a reader skip pages
by doc_id. Readers that ask for metadata alone never touch the ids, and those
that ask for some documents read their pages alone.

Files: the rows are range-partitioned by doc_id, so a file holds one range,
``file_no`` counts the ranges, and ``start_in_file`` the ids of a file before
a document. ``starts`` adds the totals of the files before, one number a file.

Defined results: null text counts as empty and is stored as the end id alone;
null doc_ids come first; rows that share a doc_id are ordered by a hash of
their text, and equal rows repeat; empty tables give a store without rows;
extra columns are not stored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navedge.session import scratch_path

from .common import bound_batches, read_table, slices
from .tokens import together, worker_encoder

#: The writer's settings.
FORMAT = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}
SCHEMA = "doc_id long, n_tokens long, start_in_file long, file_no int, ids array<int>"


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Rows of the store, in the order of ``docs``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, file_no, before = worker_encoder(tokenizer_path, True), TaskContext.get().partitionId(), 0
        for doc_ids, texts in together(slices(batches)):
            ids, sizes = encode.column(texts, end_id)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(sizes), pa.array(ends[:-1] + before),
                 pa.array(np.full(len(sizes), file_no, np.int32)), lists],
                ["doc_id", "n_tokens", "start_in_file", "file_no", "ids"])
            before += int(ends[-1])

    return docs.mapInArrow(run, SCHEMA)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, files: int | None = None) -> None:
    """Encode every whole text and write the store."""
    bound_batches(docs.sparkSession)
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    encoded(ordered, tokenizer_path, end_id).write.options(**FORMAT).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, start: columns of a few bytes a document; the ids are not read."""
    rows = read(spark, path).drop("ids")
    return starts(rows, rows)


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """Rows of the given documents; the filter reaches row groups and pages."""
    return read(spark, path).where(F.col("doc_id").isin(*map(int, doc_ids)))


def starts(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` with ``start``: ids of all documents before. One total for each file of ``stored`` is summed up."""
    totals = stored.groupBy("file_no").agg(F.max(F.col("start_in_file") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("file_no", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    # One row a file.
    return rows.join(F.broadcast(first), "file_no").withColumn("start", F.col("first") + F.col("start_in_file")).drop(
        "first", "file_no", "start_in_file")


def digests(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ids_crc32`` in place of ``ids``: crc32 of the ids as little-endian 32-bit integers."""
    names = [n for n in rows.columns if n != "ids"]

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("ids")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(np.array(crc, np.int64))], [*names, "ids_crc32"])

    kept = rows.drop("ids").schema
    return rows.mapInArrow(run, kept.add("ids_crc32", "long"))


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write(read_table(spark, sf_dir, "documents"), path, byte_bpe_path(), end_id=2)
    rows = read(spark, path)
    return starts(digests(rows), rows).select("doc_id", "start", "n_tokens", "ids_crc32")
