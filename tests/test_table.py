"""Stored tables by key, bucketed totals, one publication for several sinks, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from navedge import schema as S
from navedge.functions.parse import tab_message
from navedge.plans import questions as Q
from navedge.sinks import table as T
from navedge.sources.events import clickstream, load_clicks
from test_plans import plan

KEYS = ["prev", "curr", "type"]
EDGES = "prev string, curr string, type string, n long"


def files(root):
    """Every data file with its size, by folder."""
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_batch_rewrites_only_its_buckets(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    first = spark.range(500).selectExpr("concat('p', id % 50) prev", "concat('c', id) curr", "'link' type", "id n")
    assert T.replace_batch(first, path, 0, KEYS, buckets=16) == list(range(16))
    before = files(path)
    assert len(before) == 16  # a file a bucket
    batch = spark.createDataFrame([("p1", "c1", "link", 1000), (None, None, "link", 7), ("p1", "c1", "link", 999)], EDGES)
    touched = T.replace_batch(batch, path, 1, KEYS)
    new = set(files(path)) - set(before)
    assert len(touched) == len(new) <= 2 and all(f"bucket={b}/version=1" in " ".join(new) for b in touched)
    want = [r for r in rows(first) if r[1] != "c1"] + [("p1", "c1", "link", 1000), (None, None, "link", 7)]
    assert rows(T.read_table(spark, path)) == sorted(want, key=repr)
    assert rows(T.read_table(spark, path, 0)) == rows(first)
    # null keys are replaced too
    T.replace_batch(spark.createDataFrame([(None, None, "link", 8)], EDGES), path, 2, KEYS)
    assert T.read_table(spark, path).where("prev IS NULL").first().n == 8


def test_replay_changes_nothing_and_a_failure_leaves_the_table(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "t")
    for i, n in enumerate((1, 2)):
        T.replace_batch(spark.createDataFrame([("a", "b", "x", n), ("c", f"{i}", "x", n)], EDGES), path, i, KEYS, buckets=4)
    table, sizes = rows(T.read_table(spark, path)), sorted(files(path).values())
    for i, n in ((0, 1), (1, 2)):  # the older batch too: it starts from the manifest before it
        T.replace_batch(spark.createDataFrame([("a", "b", "x", n), ("c", f"{i}", "x", n)], EDGES), path, i, KEYS, buckets=4)
        assert rows(T.read_table(spark, path, i)) == rows(T.read_table(spark, path, i))
    assert rows(T.read_table(spark, path)) == table and sorted(files(path).values()) == sizes
    monkeypatch.setattr(T, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        T.replace_batch(spark.createDataFrame([("a", "b", "x", 99)], EDGES), path, 2, KEYS)
    assert rows(T.read_table(spark, path)) == table


def test_vacuum_order_and_wrong_batches(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    for i in range(4):
        T.replace_batch(spark.createDataFrame([("a", "b", "x", i), ("a", f"{i}", "x", i)], EDGES), path, i, KEYS, buckets=2)
    table = rows(T.read_table(spark, path))
    assert T.vacuum(spark, path, keep=1) > 0 and rows(T.read_table(spark, path)) == table
    assert T.manifests(spark, path) == [3] and T.vacuum(spark, path, keep=1) == 0
    dated = spark.createDataFrame([("a", "b", "x", 5, 2), ("a", "b", "x", 6, 1)], EDGES + ", day int")
    T.replace_batch(dated, path, 4, KEYS, order="day")
    assert T.read_table(spark, path).where("curr = 'b'").first().n == 5
    assert T.replace_batch(spark.createDataFrame([], EDGES), path, 5, KEYS) == [] and T.manifests(spark, path)[-1] == 5
    with pytest.raises(ValueError):
        T.replace_batch(spark.createDataFrame([("a", 1)], "prev string, m long"), path, 6, ["prev"])
    with pytest.raises(FileNotFoundError):
        T.read_table(spark, os.path.join(tmpdir_path, "none"))


def test_stored_totals_join_without_an_exchange(spark):
    edges = clickstream(load_clicks(spark, SF_SMALL))
    T.save_bucketed(Q.page_views(edges), "nv_test_in", "Article", 4)
    T.save_bucketed(Q.link_clicks(edges), "nv_test_out", "link_clicked", 4)
    try:
        got = T.bucketed_flow(spark, "nv_test_in", "nv_test_out")
        broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            p = plan(T.bucketed_flow(spark, "nv_test_in", "nv_test_out"))
            one = plan(T.bucketed_flow(spark, "nv_test_in", "nv_test_out").where("Article = 'Deaths_in_2015'"))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert rows(got) == rows(Q.flow_one_pass(edges))
        assert "SelectedBucketsCount: 1 out of 4" in one  # question 6 reads one bucket
    finally:
        for t in ("nv_test_in", "nv_test_out"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_sinks_are_published_together(spark, tmpdir_path):
    from navedge.streaming.engine import legs_handler, read_leg
    root = os.path.join(tmpdir_path, "legs")
    odd = spark.createDataFrame([("a\nb", 'q"u,o', "\\N", 1), (None, "", " x ", None), ("t\ta", "\r\n", "\\", 3)], EDGES)

    def fails(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("the table is away")

    handle = legs_handler(root, {"q1": Q.top_articles}, fails)
    handle(odd, 0)
    with pytest.raises(RuntimeError):
        handle(odd.limit(1), 1)  # after CSV and Parquet, before the table
    assert os.path.exists(f"{root}/csv/batch_id=1") and os.path.exists(f"{root}/parquet/batch_id=1")
    for leg in ("csv", "parquet"):
        assert rows(read_leg(spark, root, leg)) == rows(odd)
    assert rows(read_leg(spark, root, "answers/q1")) == rows(Q.top_articles(odd))
    lines = spark.read.text(f"{root}/csv/batch_id=0").count()
    heads = len(files(root)) and len([f for f in os.listdir(f"{root}/csv/batch_id=0") if f.endswith(".csv")])
    assert lines == 3 + heads  # a row is a line, so a file can be split


def test_log_is_folded_and_trimmed_while_its_stream_goes_on(spark, tmpdir_path, capsys):
    from navedge.__main__ import main
    from navedge.sinks.versioned import committed
    from navedge.streaming.engine import current_edges
    at = lambda *p: os.path.join(tmpdir_path, *p)
    clicks = load_clicks(spark, SF_SMALL).cache()

    def stream(part, text):
        tab_message(clicks.where(part).repartition(3), escaped=True).write.mode("append").text(at("src"))
        assert main(["stream", "--source-dir", at("src"), at("ckpt"), "--out", at("log"), "--trigger", "availableNow", "--max-files-per-trigger", "1",
                     "--escaped"]) == 0, text

    stream("event_id < 500", "first")
    folders = [f for f in os.listdir(at("log")) if f.startswith("batch_id=")]
    assert len(folders) >= 3 and main(["compact", "--log", at("log"), "--trim"]) == 0
    assert f"removed {len(folders)} folders" in capsys.readouterr().out
    assert not [f for f in os.listdir(at("log")) if f.startswith("batch_id=")]
    assert rows(current_edges(spark, at("log"))) == rows(clickstream(clicks.where("event_id < 500")))
    stream("event_id >= 500", "second")
    assert rows(current_edges(spark, at("log"))) == rows(clickstream(clicks))
    assert main(["compact", "--log", at("log"), "--trim"]) == 0
    assert [f for f in os.listdir(at("log")) if f.startswith(("batch_id=", "base="))] == [f"base={committed(spark, at('log'), '_bases')[-1]}"]
    assert rows(current_edges(spark, at("log"))) == rows(clickstream(clicks))
    clicks.unpersist()
