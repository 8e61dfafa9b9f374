"""A user holding a third of all events must not land in one task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from navedge.operators.sequence import skew_safe_lag
from navedge.sources.events import clicks, clickstream

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def skewed(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return ev.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(0))
                         .otherwise(F.col("user_id")))


def test_hot_user_is_a_third(skewed):
    total = skewed.count()
    assert skewed.where("user_id = 0").count() / total > 0.33


@pytest.mark.parametrize("slices", [16, 32])
def test_tasks_stay_balanced(skewed, slices):
    total = skewed.count()
    out = skew_safe_lag(skewed, "user_id", ["ts", "event_id"], "props", "p", slices)
    biggest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest / total < 2.0 / slices


def test_exact_under_skew(skewed):
    a = skew_safe_lag(skewed, "user_id", ["ts", "event_id"], "props", "p", 16)
    b = skewed.withColumn("q", F.lag("props").over(
        Window.partitionBy("user_id").orderBy("ts", "event_id")))
    j = a.select("event_id", "p").join(b.select("event_id", "q"), "event_id")
    assert j.where(~F.col("p").eqNullSafe(F.col("q"))).count() == 0
    assert j.count() == skewed.count()


def test_edge_table_under_skew_matches_plain_derivation(skewed):
    # the fixture's edge table computed with many slices equals one slice
    a = clickstream(clicks(skewed, num_slices=32))
    b = clickstream(clicks(skewed, num_slices=1))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_copies_of_one_event_are_split(spark):
    # a third of all rows are exact copies of one event
    ev = spark.read.parquet(f"{SF}/events.parquet")
    copies = (ev.where("event_id = 7")
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50000))))
              .drop("copy"))
    data = ev.unionByName(copies)
    total = data.count()
    out = skew_safe_lag(data, "user_id", ["ts", "event_id"], "props", "p", 16)
    biggest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest / total < 2.0 / 16
    plain = data.withColumn("p", F.lag("props").over(
        Window.partitionBy("user_id").orderBy("ts", "event_id")))
    key = ["event_id", "p"]
    assert out.groupBy(*key).count().exceptAll(plain.groupBy(*key).count()).count() == 0
