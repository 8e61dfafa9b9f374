"""Streams: restart from a checkpoint, replayed batch ids, watermark route."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from navedge import schema as S
from navedge.functions.parse import json_message, tab_message
from navedge.plans import questions as Q
from navedge.sinks.versioned import read_latest_snapshot, read_versions
from navedge.sources.events import clickstream, load_clicks
from navedge.sources.messages import kafka_options, text_stream
from navedge.streaming.engine import (answers_handler, await_done, change_log_handler,
                                      current_edges, edge_totals, fanout_handler,
                                      parse_messages, run_change_log)
from navedge.streaming.windows import run_window_counts


def _edge_rows(df):
    return rows(df.select(*S.EDGE_COLUMNS))


def test_restart_from_checkpoint_equals_batch(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL).cache()
    src = os.path.join(tmpdir_path, "src")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    log = os.path.join(tmpdir_path, "log")
    first, second = clicks.where("event_id < 500"), clicks.where("event_id >= 500")
    tab_message(first.repartition(2)).write.mode("append").text(src)

    def run():
        stream = parse_messages(text_stream(spark, src, max_files_per_trigger=1), "tab")
        q, _ = run_change_log(edge_totals(stream), log, ckpt)
        await_done(q)

    run()
    n_batches_1 = read_versions(spark, log).select("batch_id").distinct().count()
    tab_message(second.repartition(2)).write.mode("append").text(src)
    run()
    n_batches_2 = read_versions(spark, log).select("batch_id").distinct().count()
    assert n_batches_2 > n_batches_1 >= 1
    assert _edge_rows(current_edges(spark, log)) == _edge_rows(clickstream(clicks))
    clicks.unpersist()


def test_replayed_batch_id_changes_nothing(spark, tmpdir_path):
    edges = clickstream(load_clicks(spark, SF_SMALL)).cache()
    out = os.path.join(tmpdir_path, "answers")
    h = answers_handler({"q1": Q.top_articles}, out)
    h(edges, 0)
    h(edges, 0)
    snap = read_latest_snapshot(spark, f"{out}/q1")
    assert rows(snap) == rows(Q.top_articles(edges))

    log = os.path.join(tmpdir_path, "log")
    c = change_log_handler(log)
    c(edges, 3)
    c(edges, 3)
    assert read_versions(spark, log).count() == edges.count()

    csv, pq = os.path.join(tmpdir_path, "csv"), os.path.join(tmpdir_path, "pq")
    f = fanout_handler(csv, pq)
    f(edges, 1)
    f(edges, 1)
    assert spark.read.option("header", "true").csv(csv).count() == edges.count()
    assert read_versions(spark, pq).count() == edges.count()
    edges.unpersist()


def test_json_strict_stream_drops_empty_messages(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "json")
    json_message(clicks).unionByName(spark.createDataFrame([("bad",)], "value string")) \
        .write.text(src)
    stream = parse_messages(text_stream(spark, src), "json", strict=True)
    q, log = run_change_log(edge_totals(stream), os.path.join(tmpdir_path, "log"),
                            os.path.join(tmpdir_path, "ckpt"))
    await_done(q)
    assert _edge_rows(current_edges(spark, log)) == _edge_rows(clickstream(clicks))


def test_window_stream_with_watermark(spark, tmpdir_path):
    from navedge.operators.window import sliding_counts
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("ts", "event_type")
    src = os.path.join(tmpdir_path, "ev")
    # files must arrive in event-time order, or the watermark rightly drops
    # the events of a file read after a later one
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 3
    for i in range(3):
        a, b = lo + step * i, lo + step * (i + 1)
        part = ev.where((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) &
                        ((F.col("ts") < F.lit(b).cast("timestamp_ntz")) if i < 2 else F.lit(True)))
        part.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(src)
    q, log = run_window_counts(stream, "ts", ["event_type"], watermark="1 hour",
                               path=os.path.join(tmpdir_path, "log"),
                               checkpoint=os.path.join(tmpdir_path, "ckpt"))
    await_done(q)
    from navedge.sinks.versioned import read_latest_per_key
    got = read_latest_per_key(spark, log, ["event_type", "window_start", "window_end"]).select(
        "event_type", F.col("window_start").cast("timestamp_ntz"),
        F.col("window_end").cast("timestamp_ntz"), "count")
    assert rows(got) == rows(sliding_counts(ev, "ts", ["event_type"]))


def test_kafka_options():
    o = kafka_options("h:9092", "subscribe", "clickers")
    assert o == {"kafka.bootstrap.servers": "h:9092", "subscribe": "clickers",
                 "startingOffsets": "earliest", "failOnDataLoss": "true"}
    o = kafka_options("h:9092", "assign", "{}", "latest", fail_on_data_loss=False, max_offsets_per_trigger=500)
    assert (o["failOnDataLoss"], o["maxOffsetsPerTrigger"], o["startingOffsets"]) == ("false", "500", "latest")
    import pytest
    with pytest.raises(ValueError):
        kafka_options("h:9092", "topic", "clickers")


def test_staged_stream_runs_several_batches(spark):
    from navedge.sources.messages import files_per_trigger, stage_messages
    from navedge.streaming.engine import run_answers
    path = stage_messages(load_clicks(spark, SF_SMALL), "tab")
    per = files_per_trigger(spark, path, 4)
    stream = parse_messages(text_stream(spark, path, per), "tab")
    q, out = run_answers(edge_totals(stream), {"q1": Q.top_articles})
    await_done(q)
    batches = [p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) >= 2


def test_registered_stream_keys_run_several_batches_and_partitions(spark):
    from navedge.plans import catalog as C
    q, _ = run_change_log(edge_totals(C._parsed_stream(spark, SF_SMALL, "tab")))
    await_done(q)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 3
    assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] >= 4


def test_question_filters_sit_below_the_state(spark):
    from navedge.plans import catalog as C
    for question, value in ((Q.top_from_referer, S.DEFAULT_REFERER), (Q.missing_pages, S.DEFAULT_MISSING_TYPE)):
        plan = question(C._parsed_stream(spark, SF_SMALL, "json"))._jdf.queryExecution().analyzed().toString()
        assert plan.index("Aggregate") < plan.index("Filter") and value in plan


def test_await_any_times_out(spark):
    from navedge.streaming.engine import await_any
    spark.streams.resetTerminated()
    assert await_any(spark, 0.1) is False


def test_console_route(spark, tmpdir_path):
    from navedge.streaming.engine import run_console
    src = os.path.join(tmpdir_path, "c")
    tab_message(load_clicks(spark, SF_SMALL).limit(5)).write.text(src)
    q = run_console(parse_messages(text_stream(spark, src)), trigger="availableNow", checkpoint=os.path.join(tmpdir_path, "k"))
    await_done(q)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 5
