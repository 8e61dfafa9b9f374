"""Inflow against outflow per article.

``in_count`` of an article is the sum of ``n`` over edges *into* it
(``curr``), ``out_count`` the sum over edges *out of* it (``prev``); only
articles with at least one edge on each side are kept, as the inner join of
the two totals does. ``ratio = out_count / in_count`` and is null, not an
error, when ``in_count`` is 0 or null.

Two plans with equal results:

* ``flow_one_pass`` explodes every edge into an in-row and an out-row and
  groups once by article: one scan, one shuffle (partial sums before it).
  Used for the whole table.
* ``flow_join`` aggregates each side and joins them. The two aggregates come
  out hash-partitioned on the article, so the join adds no exchange, and a
  filter on the article is pushed into both scans. Used for one article.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navedge.schema import FLOW_COLUMNS

ARTICLE, IN_COUNT, OUT_COUNT, RATIO = FLOW_COLUMNS


def _ratio():
    return F.try_divide(F.col(OUT_COUNT), F.col(IN_COUNT)).cast("double").alias(RATIO)


#: Edges on each side of an article, beside their sums: a side whose n are all null still joins.
IN_ROWS, OUT_ROWS = "in_rows", "out_rows"


def flow_totals(edges: DataFrame) -> DataFrame:
    """``Article, in_count, out_count, in_rows, out_rows`` of every title: one grouping of tagged rows.

    The same plan on a stream is one stateful operator whose state holds a row per title, whatever the number of edges.
    """
    sides = F.array(
        F.struct(F.col("curr").alias("a"), F.col("n").alias("v"), F.lit(True).alias("inbound")),
        F.struct(F.col("prev").alias("a"), F.col("n").alias("v"), F.lit(False).alias("inbound")))
    rows = edges.select(F.inline(sides)).where(F.col("a").isNotNull())
    inbound = F.col("inbound")
    return rows.groupBy(F.col("a").alias(ARTICLE)).agg(
        F.sum(F.when(inbound, F.col("v"))).cast("bigint").alias(IN_COUNT),
        F.sum(F.when(~inbound, F.col("v"))).cast("bigint").alias(OUT_COUNT),
        F.count_if(inbound).alias(IN_ROWS), F.count_if(~inbound).alias(OUT_ROWS))


def flow_of_totals(totals: DataFrame) -> DataFrame:
    """The answer from ``flow_totals``: titles with edges on both sides."""
    return (totals.where((F.col(IN_ROWS) > 0) & (F.col(OUT_ROWS) > 0))
            .select(ARTICLE, IN_COUNT, OUT_COUNT, _ratio()))


def flow_one_pass(edges: DataFrame) -> DataFrame:
    return flow_of_totals(flow_totals(edges))


def flow_join(edges: DataFrame, article: str | None = None) -> DataFrame:
    src = edges
    ins = src if article is None else src.where(F.col("curr") == article)
    outs = src if article is None else src.where(F.col("prev") == article)
    inflow = ins.groupBy(F.col("curr").alias(ARTICLE)).agg(F.sum("n").cast("bigint").alias(IN_COUNT))
    outflow = outs.groupBy(F.col("prev").alias("link_clicked")).agg(
        F.sum("n").cast("bigint").alias(OUT_COUNT))
    return flow_of_stored_totals(inflow, outflow)


def flow_of_stored_totals(inflow: DataFrame, outflow: DataFrame) -> DataFrame:
    """The answer from both totals: ``Article, in_count`` and ``link_clicked, out_count``."""
    joined = inflow.join(outflow, inflow[ARTICLE] == outflow["link_clicked"], "inner")
    return joined.select(ARTICLE, IN_COUNT, OUT_COUNT, _ratio())
