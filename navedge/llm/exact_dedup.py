"""Exact deduplication with keyed streaming state.

Every document becomes one narrow *arrival*: digest of its normalised text,
length, identifier and content locator (file and row number). A Structured
Streaming query over the arrivals keeps one state row per digest in RocksDB,
without expiry: the best row so far and how many arrived. Arrivals of one
digest are merged inside each task before the shuffle, so a text that holds a
third of all rows reaches the state as one row per task. The state and its
checkpoint can be kept, and a later run over a folder that gained files adds
to it.

A digest that was hit more than once is not trusted: the full normalised text
of every member is compared with that of the row the state holds. The join is
salted, with one copy of the held text for each ``SALT_ROWS`` members. Digests
with any difference are grouped again by the text itself.

Defined results: null text counts as empty; a null doc_id loses every tie;
rows that repeat (same doc_id and text) are members of one group, of which
exactly one row is kept; empty tables give empty results; other columns of the
input are neither read nor returned by ``assign_groups`` and pass unchanged
through ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navedge.session import scratch_path

from .common import BROADCAST_ROWS, broadcast_if_small, sheltered, staged, write_scratch

#: Members that compare themselves with one copy of the held text.
SALT_ROWS = 256
#: Memory of all state stores of an executor.
STATE_MB = 128
#: Files of arrivals that one micro-batch takes.
FILES_PER_TRIGGER = 1000

_SPACE = r"[\x20\x09-\x0D]+"
_INT64 = "long"


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, "")


def digest_of(norm):
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_nv_file`` and ``_nv_row``; staged first if no file backs it."""
    try:
        meta = docs.metadataColumn("_metadata")
        out = docs.withColumns({"_nv_file": meta["file_path"], "_nv_row": meta["row_index"]})
        out.schema
        return out
    except Exception as e:  # only Spark's analysis says whether files back the frame
        if type(e).__name__ != "AnalysisException":
            raise
    docs = staged(docs, "dedup-input")
    meta = docs.metadataColumn("_metadata")
    return docs.withColumns({"_nv_file": meta["file_path"], "_nv_row": meta["row_index"]})


def arrivals(docs: DataFrame, digest=digest_of) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast(_INT64).alias("doc_id"),
        digest(normalised(F.col("text"))).alias("digest"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast(_INT64).alias("n_points"),
        F.col("_nv_file").alias("file"), F.col("_nv_row").alias("row"))


def _best():
    # The greatest: most code points, then smallest doc_id (bitwise not reverses the order without overflow).
    return F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("inv_id"), "file", "row"))


def run_state(spark: SparkSession, arrivals_path: str, schema, state_dir: str, log_dir: str,
              files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Feed new files of arrivals to the keyed state; return one row per digest.

    The state and the log stay, so a second call with the same folders reads
    only files that came since, and answers for all.
    """
    child = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        child.conf.set(key, spark.conf.get(key))
    child.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(STATE_MB))
    # Files as large as their content: each of many stores would set megabytes aside.
    child.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    state = (child.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(arrivals_path)
             .groupBy("digest").agg(_best().alias("best"), F.count(F.lit(1)).alias("n")))

    def log(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_dir}/batch_id={batch_id}")

    query = (state.writeStream.outputMode("update").foreachBatch(log)
             .option("checkpointLocation", state_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    changes = spark.read.schema(state.schema).parquet(f"{log_dir}/batch_id=*")
    # Counts and best rows only grow, so the greatest of each is the latest.
    return changes.groupBy("digest").agg(F.max("best").alias("best"), F.max("n").alias("n"))


def assign_groups(docs: DataFrame, digest=digest_of, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and the locator (file, row)."""
    return _assign(located(docs), digest, broadcast_rows)


def _assign(docs: DataFrame, digest, broadcast_rows: int) -> DataFrame:
    spark = docs.sparkSession
    rows = arrivals(docs, digest)
    path = write_scratch(rows, "dedup-arrivals")
    rows = spark.read.schema(rows.schema).parquet(path)
    if rows.isEmpty():
        groups = rows.groupBy("digest").agg(_best().alias("best"), F.count(F.lit(1)).alias("n"))
    else:
        groups = run_state(spark, path, rows.schema, scratch_path(spark, "dedup-state"), scratch_path(spark, "dedup-log"))
    groups = staged(groups, "dedup-groups")
    wrong = staged(mismatches(docs, groups, digest, broadcast_rows), "dedup-wrong")
    keyed = rows.join(groups, "digest")
    if wrong.isEmpty():
        out = keyed
    else:
        # Digests of several texts: group their rows by the text itself.
        texts = _members(docs, wrong, digest, broadcast_rows)
        own = texts.groupBy("digest", "norm").agg(_best().alias("best"), F.count(F.lit(1)).alias("n"))
        split = texts.join(own, ["digest", "norm"]).drop("norm")
        out = keyed.join(wrong, "digest", "left_anti").unionByName(split.select(keyed.columns))
    return out.select(
        "doc_id", F.bitwise_not("best.inv_id").alias("keep_id"), F.col("n").alias("group_size"),
        F.expr("best.file = file AND best.row = row").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "file", "row")


def _members(docs: DataFrame, digests: DataFrame, digest, broadcast_rows: int) -> DataFrame:
    norm = normalised(F.col("text"))
    full = docs.select(
        F.col("doc_id").cast(_INT64).alias("doc_id"), norm.alias("norm"), digest(norm).alias("digest"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast(_INT64).alias("n_points"),
        F.col("_nv_file").alias("file"), F.col("_nv_row").alias("row"))
    return full.join(broadcast_if_small(digests, broadcast_rows), "digest")


def mismatches(docs: DataFrame, groups: DataFrame, digest, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Digests that stand for more than one normalised text."""
    hits = staged(groups.where("n > 1"), "dedup-hits")
    texts = _members(docs, hits, digest, broadcast_rows).withColumn("salts", F.ceil(F.col("n") / SALT_ROWS))
    held = (texts.where("best.file = file AND best.row = row")
            .select("digest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                    F.col("norm").alias("held_norm")))
    members = texts.select("digest", "norm", F.pmod(F.xxhash64("file", "row"), F.col("salts")).alias("salt"))
    return (members.join(held, ["digest", "salt"]).where(F.col("norm") != F.col("held_norm"))
            .select("digest").distinct())


def keep_first(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return sheltered(docs, lambda d: _keep_first(d, broadcast_rows))


def _keep_first(docs: DataFrame, broadcast_rows: int) -> DataFrame:
    docs = located(docs)
    dropped = staged(_assign(docs, digest_of, broadcast_rows).where("NOT kept")
                     .select(F.col("file").alias("_nv_file"), F.col("row").alias("_nv_row")), "dedup-dropped")
    return (docs.join(broadcast_if_small(dropped, broadcast_rows), ["_nv_file", "_nv_row"], "left_anti")
            .drop("_nv_file", "_nv_row"))




def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_groups(docs).drop("file", "row")


#: The same grouping in DuckDB. Lengths are code points; the greatest row of a group stays.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     n AS (SELECT doc_id, length(t) AS len, sha256(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS h FROM d)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h ORDER BY len DESC, doc_id)
"""
