"""Grouped sums, counts and top-k over edge tables.

All of these are one hash aggregation: Spark sums partially inside each map
task before the shuffle, so a hot key (``other-search`` sends a large share
of all traffic) reaches the exchange as one row per task, not one per hit.
Top-k is ``orderBy(...).limit(k)``, which Spark plans as
``TakeOrderedAndProject``: a k-row heap per task, no global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, key: str, alias_key: str, value: str = "n",
           alias_value: str = "total") -> DataFrame:
    """``SELECT key AS alias_key, SUM(value) AS alias_value GROUP BY key``."""
    return (df.groupBy(F.col(key).alias(alias_key))
            .agg(F.sum(value).cast("bigint").alias(alias_value)))


def count_by(df: DataFrame, key: str, alias_value: str = "count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias_value))


def total_rows(df: DataFrame, alias: str = "total_rows") -> DataFrame:
    """Whole-table row count as a one-row frame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def ranked(df: DataFrame, by: str, tie_breaks: list[str]) -> list[Column]:
    """Descending on ``by`` with ascending tie-breaks; nulls last throughout,
    so the order (and therefore any limit) is total and deterministic."""
    return [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_breaks]]


def top_k(df: DataFrame, by: str, k: int, tie_breaks: list[str] | None = None) -> DataFrame:
    if tie_breaks is None:
        tie_breaks = [c for c in df.columns if c != by]
    return df.orderBy(*ranked(df, by, tie_breaks)).limit(int(k))


def sorted_desc(df: DataFrame, by: str, tie_breaks: list[str] | None = None) -> DataFrame:
    """Full descending sort (range-partitioned by Spark, no single-task sort)."""
    if tie_breaks is None:
        tie_breaks = [c for c in df.columns if c != by]
    return df.orderBy(*ranked(df, by, tie_breaks))


def token_counts(text: DataFrame, column: str = "value", sep: str = "\t") -> DataFrame:
    """Count of every separator-delimited token in a text column."""
    tokens = text.select(F.explode(F.split(F.col(column), _regex_literal(sep), -1)).alias("value"))
    return tokens.groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def _regex_literal(sep: str) -> str:
    import re
    return re.escape(sep) if sep != "\t" else "\t"
