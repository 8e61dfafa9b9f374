"""skew_safe_lag equals lag() over a plain window, whatever the slicing."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from navedge.operators.sequence import skew_safe_lag


def _plain(df, key, order, value, out):
    return df.withColumn(out, F.lag(value).over(Window.partitionBy(key).orderBy(*order)))


def _diff(a, b, id_col, out):
    j = a.select(id_col, F.col(out).alias("x")).join(b.select(id_col, F.col(out).alias("y")), id_col)
    return j.where(~F.col("x").eqNullSafe(F.col("y"))).count(), j.count()


@pytest.mark.parametrize("slices", [1, 3, 8, 50])
def test_equals_window_lag_on_events(spark, slices):
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    a = skew_safe_lag(ev, "user_id", ["ts", "event_id"], "props", "p", slices)
    b = _plain(ev, "user_id", ["ts", "event_id"], "props", "p")
    bad, total = _diff(a, b, "event_id", "p")
    assert bad == 0 and total == ev.count()


def test_hot_key_spread_over_slices(spark):
    # one key holds ~half the rows: it must span many slices and still be exact
    df = spark.range(0, 20000).select(
        F.col("id"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") * 7919 % 20000).alias("o"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("v"))
    a = skew_safe_lag(df, "k", ["o", "id"], "v", "p", 16)
    sliced = df.repartitionByRange(16, "k", "o", "id").select("k", F.spark_partition_id().alias("s"))
    assert sliced.where("k = 0").select("s").distinct().count() > 4
    b = _plain(df, "k", ["o", "id"], "v", "p")
    bad, total = _diff(a, b, "id", "p")
    assert bad == 0 and total == 20000


def test_null_keys_form_one_partition(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, 1, "c"), (4, 1, "d")],
                               "id int, k int, v string")
    a = skew_safe_lag(df, "k", ["id"], "v", "p", 3)
    got = {r.id: r.p for r in a.collect()}
    assert got == {1: None, 2: "a", 3: None, 4: "c"}
