"""Relational tables through Spark's JDBC writer.

* whole answers (questions 1-9) are written with ``mode("overwrite")`` and
  ``truncate=true``: writing the same answer again leaves one copy;
* an append stream fills one table. Its rows carry the batch id and the
  attempt that wrote them; when a batch is through, one row in
  ``<table>_commits`` names its attempt. A replayed batch that was committed
  writes nothing; rows of an attempt that failed half-way stay unnamed, and
  ``read_appended`` leaves them out.

The table definition comes from the DataFrame schema. Nothing here opens a
connection by itself: the URL names a database the caller runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, extra: dict[str, str] | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def write_table(df: DataFrame, options: dict[str, str], mode: str = "overwrite",
                truncate: bool = True, batch_size: int = 10000) -> None:
    w = df.write.format("jdbc").options(**options).option("batchsize", str(batch_size))
    if mode == "overwrite" and truncate:
        w = w.option("truncate", "true")
    w.mode(mode).save()


def read_table(spark: SparkSession, options: dict[str, str], partition_column: str, lower: int | str, upper: int | str,
               partitions: int) -> DataFrame:
    """The table in ``partitions`` parallel ranges of one numeric, date or timestamp column.

    The bounds only place the ranges: rows outside them are read too.
    """
    return spark.read.format("jdbc").options(**options, partitionColumn=partition_column, lowerBound=str(lower),
                                             upperBound=str(upper), numPartitions=str(int(partitions))).load()


COMMIT_COLUMNS = "batch_id long, attempt string"


def commit_table(options: dict[str, str]) -> dict[str, str]:
    return {**options, "dbtable": f"{options['dbtable']}_commits"}


def is_committed(spark: SparkSession, options: dict[str, str], batch_id: int) -> bool:
    """Whether the commit table, which must exist, names the batch (the filter runs in the database)."""
    commits = spark.read.format("jdbc").options(**commit_table(options)).load()
    return not commits.where(F.col("batch_id") == int(batch_id)).isEmpty()


def create_commit_table(spark: SparkSession, options: dict[str, str]) -> None:
    """Make the commit table if it isn't there (an append of no rows)."""
    write_table(spark.createDataFrame([], COMMIT_COLUMNS), commit_table(options), "append")


def read_appended(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows of committed attempts, from the two tables of an append stream."""
    return rows.join(commits.select("batch_id", "attempt").distinct(), ["batch_id", "attempt"], "left_semi").drop("batch_id", "attempt")


def foreach_batch_writer(options: dict[str, str], whole_answer: bool = False):
    """A ``foreachBatch`` function: whole answers overwrite one table, append streams fill one."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if whole_answer:
            write_table(batch, options, "overwrite")
            return
        spark, attempt = batch.sparkSession, uuid.uuid4().hex
        create_commit_table(spark, options)
        if is_committed(spark, options, batch_id):
            return
        marked = batch.withColumns({"batch_id": F.lit(int(batch_id)).cast("long"), "attempt": F.lit(attempt)})
        write_table(marked, options, "append")
        write_table(spark.createDataFrame([(int(batch_id), attempt)], COMMIT_COLUMNS), commit_table(options), "append")
    return write
