"""Ordered-sequence operators that stay balanced when one key is huge.

``lag(x) OVER (PARTITION BY key ORDER BY o)`` in Spark sends every row of a
key to one task. When one user holds a third of all events, that task holds a
third of the data. ``skew_safe_lag`` computes the same column with bounded
tasks, in one linear plan (each input row is read and shuffled by a single
lineage, so re-execution after a lost executor sees the same slices):

1. range-partition on ``(key, o...)``: the sampler cuts a hot key into many
   contiguous slices of about ``rows / num_slices`` rows;
2. lag inside each ``(key, slice)`` with a window; mark each slice's first
   and last row;
3. a second window whose partition is ``(key, -1)`` for those boundary rows
   and ``(key, slice)`` for the rest. The boundary group of a key holds at
   most two rows per slice, and in it the row before a slice's first row is
   the previous slice's last row: the lag there is the missing value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navedge.session import default_parallelism

_ROW = "_nv_row"
_SLICE = "_nv_slice"
_FIRST = "_nv_first"
_GROUP = "_nv_group"
_CARRY = "_nv_carry"


def skew_safe_lag(df: DataFrame, key: str, order: list[str], value: str | Column, out: str,
                  num_slices: int | None = None, value_name: str = "_nv_value") -> DataFrame:
    """Add ``out`` = lag(``value``) over (partition by ``key`` order by ``order``).

    ``order`` must make the order total within a key (add a unique id), as
    any deterministic lag requires. ``value`` may be an expression: it is then
    computed once per row right after the range exchange (so Spark's sampling
    pass for the range bounds does not evaluate it) and kept as ``value_name``.
    """
    n = num_slices or default_parallelism(df.sparkSession)
    # A row id as the last sort key: exact copies of one row (same key and
    # order values) would otherwise be one range key that no slice can split.
    # Copies carry equal values, so their order among themselves changes no
    # lag; the id depends only on the scan's fixed splits, so a recomputed
    # task assigns the same ids.
    order = [*order, _ROW]
    sliced = (df.withColumn(_ROW, F.monotonically_increasing_id())
              .repartitionByRange(n, key, *order)
              .withColumn(_SLICE, F.spark_partition_id()))
    if isinstance(value, Column):
        sliced = sliced.withColumn(value_name, value)
        value = value_name

    w1 = Window.partitionBy(key, _SLICE).orderBy(*order)
    marker = F.lit(True)
    first = F.lag(marker).over(w1).isNull()
    last = F.lead(marker).over(w1).isNull()
    inner = sliced.select(
        "*",
        F.lag(value).over(w1).alias(out),
        first.alias(_FIRST),
        F.when(first | last, F.lit(-1)).otherwise(F.col(_SLICE)).alias(_GROUP))

    w2 = Window.partitionBy(key, _GROUP).orderBy(_SLICE, *order)
    fixed = inner.withColumn(_CARRY, F.lag(value).over(w2))
    return (fixed
            .withColumn(out, F.when(F.col(_FIRST), F.col(_CARRY)).otherwise(F.col(out)))
            .drop(_ROW, _SLICE, _FIRST, _GROUP, _CARRY))
