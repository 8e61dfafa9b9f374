"""Mutation guards of SURVEY section 5: each variant must be told apart."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE, rows
from navedge.plans import questions as Q
from navedge.sources.events import load_edges


def test_union_is_distinct_on_unlimited_lists(spark):
    e = load_edges(spark, SF_ORACLE).cache()
    into = e.where(F.col("curr").like("Deaths_in_2015"))
    out = e.where(F.col("prev").like("Deaths_in_2015"))
    shared = into.intersect(out).count()
    assert shared > 0
    u = Q.union_distinct(out, into)
    assert u.count() == into.count() + out.count() - shared
    e.unpersist()


def test_like_selects_both_titles(spark):
    e = load_edges(spark, SF_ORACLE)
    titles = {r.curr for r in Q.into_article(e, k=1000).select("curr").distinct().collect()}
    assert titles == {"Deaths_in_2015", "Deaths-in-2015"}
    exact = {r.Article for r in Q.article_flow(e).collect()}
    assert exact == {"Deaths_in_2015"}


def test_top_k_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", "x", "l", 5), ("a", "x", "l", 5), ("c", "x", "l", 5)],
                               "prev string, curr string, type string, n bigint")
    assert rows(Q.into_article(df, "x", k=2)) == [("a", "x", "l", 5), ("b", "x", "l", 5)]


def test_paths_grow_linearly_with_k(spark):
    n = 1200
    data = [(f"p{i}", "X", "l", i + 1) for i in range(n)] + [("X", f"c{i}", "l", i + 1) for i in range(n)]
    df = spark.createDataFrame(data, "prev string, curr string, type string, n bigint")
    for k in (10, 100, 1100):  # no limit on k
        [row] = Q.two_step_paths(df, "X", k).collect()
        assert row.article == "X" and len(row.in_edges) == len(row.out_edges) == k
    assert [(e.prev, e.n) for e in row.in_edges[:2]] == [("p1199", 1200), ("p1198", 1199)]


def test_same_referer_has_one_row_a_referer(spark):
    data = [("a", "X", "l", 3), ("a", "X", "r", 2), ("X", "X", "l", 9), ("X", "c", "l", 1), (None, "X", "l", 1)]
    df = spark.createDataFrame(data, "prev string, curr string, type string, n bigint")
    [row] = Q.same_referer(df, "X", 10).collect()
    assert row.prev == "X" and len(row.in_edges) == 1 and [e.curr for e in row.out_edges] == ["X", "c"]


def test_side_by_side_keeps_longer_list(spark):
    df = spark.createDataFrame([("a", "X", "l", 3), ("b", "X", "l", 2), ("X", "c", "l", 1)],
                               "prev string, curr string, type string, n bigint")
    got = rows(Q.both_lists_side_by_side(df, "X", k=10).select(
        "rank", "in_prev", "out_curr"))
    assert got == [(1, "a", "c"), (2, "b", None)]
