"""Property checks on random inputs (few examples: each one runs Spark jobs)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from navedge import schema as S
from navedge.operators.keyed import replace_into
from navedge.operators.sequence import skew_safe_lag

FEW = settings(max_examples=8, deadline=None, derandomize=True)

rows_st = st.lists(
    st.tuples(st.one_of(st.just(0), st.integers(0, 6), st.none()),  # key 0 is hot
              st.integers(0, 50),                                   # order value, ties allowed
              st.one_of(st.none(), st.text("ab", max_size=2))),     # value, may be null
    min_size=1, max_size=120)


@FEW
@given(data=rows_st, slices=st.integers(1, 9))
def test_lag_matches_window(spark, data, slices):
    df = spark.createDataFrame([(i, k, o, v) for i, (k, o, v) in enumerate(data)],
                               "id int, k int, o int, v string")
    a = skew_safe_lag(df, "k", ["o", "id"], "v", "p", slices)
    b = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("o", "id")))
    assert sorted(map(tuple, a.select("id", "p").collect())) == \
        sorted(map(tuple, b.select("id", "p").collect()))


edge_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y"]),
                             st.sampled_from(["link"]), st.integers(0, 9)), max_size=12)


@FEW
@given(target=edge_st, batch=edge_st)
def test_replace_into_idempotent_and_keyed(spark, target, batch):
    keyed = {}
    for r in target:
        keyed[r[:3]] = r
    t = spark.createDataFrame(list(keyed.values()), S.EDGE_SCHEMA)
    b = spark.createDataFrame(batch, S.EDGE_SCHEMA)
    once = replace_into(t, b)
    twice = replace_into(once, b)
    got = sorted(map(tuple, once.collect()), key=repr)
    assert got == sorted(map(tuple, twice.collect()), key=repr)
    keys = [r[:3] for r in got]
    assert len(keys) == len(set(keys))
    assert set(keys) == set(keyed) | {r[:3] for r in batch}
    batch_keys = {r[:3] for r in batch}
    assert all(r in keyed.values() for r in got if r[:3] not in batch_keys)
