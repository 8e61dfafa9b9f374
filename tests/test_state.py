"""Panes, the one-state flow, answers from state, observed streams, triggers and the routes of the command line."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from navedge import schema as S
from navedge.functions.parse import json_message, tab_message
from navedge.operators import flow
from navedge.operators.window import interval_micros, pane_of, sliding_counts, sliding_counts_by_panes
from navedge.plans import questions as Q
from navedge.sinks.versioned import read_latest_per_key
from navedge.sources.events import clickstream, load_clicks
from navedge.sources.messages import text_stream
from navedge.streaming import engine as X


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").select("ts", "event_type")


@pytest.mark.parametrize("window", [("1 hour", "5 minutes", "2 minutes"), ("10 minutes", "4 minutes", "3 minutes"), ("7 minutes", "7 minutes", "0 seconds"),
                                    ("90 minutes", "1 hour", "17 minutes"), ("2 days", "36 hours", "5 hours")])
def test_panes_equal_sliding_windows(events, window):
    for ev in (events, events.withColumn("ts", F.col("ts").cast("timestamp"))):
        got = sliding_counts_by_panes(ev, "ts", ["event_type"], *window)
        want = sliding_counts(ev, "ts", ["event_type"], *window)
        assert rows(got) == rows(want) and got.dtypes == want.dtypes


def test_pane_lengths():
    assert pane_of("1 hour", "5 minutes", "2 minutes") == ("300000000 microseconds", "120000000 microseconds")
    assert pane_of("10 minutes", "4 minutes", "3 minutes") == ("120000000 microseconds", "60000000 microseconds")
    assert interval_micros("INTERVAL 1 day 2 hours") == 26 * 3600 * 10 ** 6
    for bad in ("1 month", "minutes", "5"):
        with pytest.raises(ValueError):
            interval_micros(bad)
    with pytest.raises(ValueError):
        pane_of("5 minutes", "10 minutes", "0 seconds")


def test_an_event_is_one_state_row_with_panes(spark, events, tmpdir_path):
    from navedge.streaming.windows import current_windows, run_pane_counts, run_window_counts
    src, window = os.path.join(tmpdir_path, "ev"), {"width": "1 hour", "slide": "5 minutes", "offset": "2 minutes"}
    lo = events.agg(F.min("ts")).first()[0]
    events.where(F.col("ts") < F.lit(lo).cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).coalesce(2).write.parquet(src)
    stream = spark.readStream.schema(events.schema).parquet(src)
    panes, log = run_pane_counts(stream, "ts", ["event_type"], path=os.path.join(tmpdir_path, "a"), checkpoint=os.path.join(tmpdir_path, "ka"), **window)
    X.await_done(panes)
    windows, _ = run_window_counts(stream, "ts", ["event_type"], path=os.path.join(tmpdir_path, "b"), checkpoint=os.path.join(tmpdir_path, "kb"), **window)
    X.await_done(windows)
    held = [max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) for q in (panes, windows)]
    assert held[0] * 4 < held[1]
    assert rows(current_windows(spark, log, ["event_type"], **window)) == rows(sliding_counts(spark.read.parquet(src), "ts", ["event_type"], **window))


def _source(clicks, path, part):
    tab_message(clicks.where(part).repartition(2), escaped=True).write.mode("append").text(path)


def test_flow_is_one_stateful_operator_and_restarts(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL).cache()
    at = lambda *p: os.path.join(tmpdir_path, *p)

    def run():
        stream = X.parse_messages(text_stream(spark, at("src"), 1), escaped=True)
        q, _ = X.run_change_log(flow.flow_totals(stream), at("log"), at("ckpt"))
        X.await_done(q)
        return q

    _source(clicks, at("src"), "event_id < 500")
    run()
    _source(clicks, at("src"), "event_id >= 500")
    last = run().lastProgress
    titles = clicks.select(F.explode(F.array("prev", "curr")).alias("t")).where("t IS NOT NULL").distinct().count()
    assert len(last["stateOperators"]) == 1 and last["stateOperators"][0]["numRowsTotal"] == titles
    got = flow.flow_of_totals(read_latest_per_key(spark, at("log"), [flow.ARTICLE]))
    assert rows(got) == rows(flow.flow_one_pass(clickstream(clicks)))
    clicks.unpersist()


def test_answers_from_the_state_at_two_batches(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL).cache()
    at = lambda *p: os.path.join(tmpdir_path, *p)
    seen = []
    for part in ("event_id < 400", "event_id >= 400"):
        _source(clicks, at("src"), part)
        q, _ = X.run_state_only(X.edge_totals(X.parse_messages(text_stream(spark, at("src")), escaped=True)), at("ckpt"))
        X.await_done(q)
        seen.append(max(p["batchId"] for p in q.recentProgress if p["numInputRows"]))
    for batch_id, part in zip(seen, ("event_id < 400", "true")):
        edges, want = X.state_edges(spark, at("ckpt"), batch_id), clickstream(clicks.where(part))
        assert rows(edges) == rows(want.select(*S.EDGE_COLUMNS))
        for question in (Q.top_articles, Q.missing_pages, Q.inflow_outflow, Q.both_lists):
            assert rows(question(edges)) == rows(question(want))
    clicks.unpersist()


def test_observed_stream_counts_what_it_drops(spark, tmpdir_path):
    from navedge.streaming.observe import ProgressTable, observed_messages, read_progress
    src, table = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "progress")
    good = [(f"p{i}\tc{i}\tlink\t{i}",) for i in range(7)] + [("\\N\tc\tlink\t1",)]
    bad = [("short\tline",), ("a\tb\tlink\t5 ",), ("a\tb\tlink\tx",)]
    spark.createDataFrame(good + bad, "value string").coalesce(1).write.text(src)
    spark.createDataFrame(bad, "value string").coalesce(1).write.mode("append").text(src)
    listener = ProgressTable(spark, table, ["watched"])
    spark.streams.addListener(listener)
    try:
        q, _ = X.run_change_log(X.edge_totals(observed_messages(text_stream(spark, src, 1), strict=True, escaped=True)),
                                os.path.join(tmpdir_path, "log"), os.path.join(tmpdir_path, "ckpt"), name="watched")
        X.await_done(q)
        for _ in range(60):  # reports arrive after the batch
            if os.path.exists(f"{table}/watched/batch_id=1/_SUCCESS"):
                break
            time.sleep(0.5)
        got = sorted((r.received, r.kept, r.dropped, r.null_prev, r.null_n) for r in read_progress(spark, table, "watched").where("received > 0").collect())
        assert got == [(3, 0, 3, 0, 0), (11, 8, 3, 1, 0)]
    finally:
        spark.streams.removeListener(listener)


def test_processing_time_trigger_runs_until_stopped(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL).cache()
    at = lambda *p: os.path.join(tmpdir_path, *p)
    _source(clicks, at("src"), "event_id < 500")
    q, log = X.run_change_log(X.edge_totals(X.parse_messages(text_stream(spark, at("src"), 1), escaped=True)), at("log"), at("ckpt"), trigger="1 second")
    try:
        q.processAllAvailable()
        _source(clicks, at("src"), "event_id >= 500")  # later files start later batches
        q.processAllAvailable()
        starts = [p["timestamp"] for p in q.recentProgress if p["numInputRows"]]
        assert len(starts) >= 4 and q.isActive
    finally:
        q.stop()
    assert rows(X.current_edges(spark, log)) == rows(clickstream(clicks).select(*S.EDGE_COLUMNS))
    clicks.unpersist()


def test_answers_into_tables_and_refused_routes(spark, tmpdir_path, monkeypatch, capsys):
    from navedge.__main__ import main
    from navedge.sinks import jdbc
    clicks = load_clicks(spark, SF_SMALL)
    at = lambda *p: os.path.join(tmpdir_path, *p)
    _source(clicks, at("src"), "true")
    written = {}
    monkeypatch.setattr(jdbc, "write_table", lambda df, options, mode="overwrite", **kw: written.__setitem__((options["dbtable"], mode), rows(df)))
    common = ["stream", "--source-dir", at("src")]
    assert main([*common, at("k"), "--out", at("o"), "--route", "complete", "--trigger", "availableNow", "--escaped", "--jdbc-url", "jdbc:x", "--joined"]) == 0
    edges = clickstream(clicks)
    assert written["top_articles", "overwrite"] == rows(Q.top_articles(edges)) and written["both_lists", "overwrite"] == rows(Q.both_lists(edges))
    assert ("shared_referers", "overwrite") in written and len(written) == 13
    for route in ("append", "changelog", "console", "table"):
        assert main([*common, at("x"), "--out", at("y"), "--route", route, "--jdbc-url", "jdbc:x"]) == 2
    assert "--jdbc-url is for" in capsys.readouterr().err
    assert main([*common, at("x"), "--route", "topic"]) == 2


def test_table_state_legs_and_window_routes(spark, tmpdir_path):
    from navedge.__main__ import main
    from navedge.streaming.windows import current_windows
    clicks = load_clicks(spark, SF_SMALL).cache()
    edges = clickstream(clicks)
    at = lambda *p: os.path.join(tmpdir_path, *p)
    _source(clicks, at("src"), "true")
    common = ["--trigger", "availableNow", "--max-files-per-trigger", "1", "--escaped"]
    assert main(["stream", "--source-dir", at("src"), at("k1"), "--out", at("t"), "--route", "table", "--buckets", "4", *common]) == 0
    assert main(["vacuum", "--table", at("t"), "--keep", "1"]) == 0
    assert main(["questions", "--input", at("t"), "--input-format", "table", "--out", at("a1"), "--joined"]) == 0
    assert main(["stream", "--source-dir", at("src"), at("k2"), "--route", "state", *common]) == 0
    assert main(["questions", "--input", at("k2"), "--input-format", "state", "--out", at("a2")]) == 0
    for answers in (at("a1"), at("a2")):
        assert rows(spark.read.parquet(f"{answers}/inflow_outflow")) == rows(Q.inflow_outflow(edges))
    assert rows(spark.read.parquet(at("a1", "both_lists_side_by_side"))) == rows(Q.both_lists_side_by_side(edges))
    assert main(["stream", "--source-dir", at("src"), at("k3"), "--out", at("l"), "--route", "legs", *common]) == 0
    for leg in ("csv", "parquet"):
        assert rows(X.read_leg(spark, at("l"), leg)) == rows(clicks.select(*S.EDGE_COLUMNS))
    timed = clicks.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    timed.select(F.to_json(F.struct("ts")).alias("value")).write.text(at("timed"))
    assert main(["stream", "--source-dir", at("timed"), at("k4"), "--out", at("w"), "--route", "windows", "--time-column", "ts", "--trigger", "availableNow"]) == 0
    want = sliding_counts(clicks.withColumn("ts", F.col("ts").cast("timestamp")), "ts", [])
    assert rows(current_windows(spark, at("w"), [])) == rows(want)
    clicks.unpersist()


def test_messages_of_json_keep_their_counts(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL)
    json_message(clicks).write.text(os.path.join(tmpdir_path, "j"))
    q, ckpt = X.run_state_only(X.edge_totals(X.parse_messages(text_stream(spark, os.path.join(tmpdir_path, "j")), "json")))
    X.await_done(q)
    assert rows(X.state_edges(spark, ckpt)) == rows(clickstream(clicks).select(*S.EDGE_COLUMNS))


def test_state_handed_over_to_more_partitions(spark, tmpdir_path):
    """Stopped, continued at four times the partitions, stopped and continued again: the batch answer, nothing read twice."""
    from navedge.streaming import handover
    clicks = load_clicks(spark, SF_SMALL).cache()
    at = lambda *p: os.path.join(tmpdir_path, *p)
    checkpoints, parts = [at("k0"), at("k1"), at("k2")], ("event_id < 300", "event_id >= 300 AND event_id < 600", "event_id >= 600")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for i, part in enumerate(parts):
            _source(clicks, at("a b"), part)
            partitions = 2 * 4 ** i
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            for _ in range(2):  # the second start finds the seed and the checkpoint, and nothing to read
                raw = text_stream(spark, at("a b"), 1) if i == 0 else handover.remaining_text(spark, at("a b"), checkpoints[i - 1], 1)
                edges = X.parse_messages(raw, escaped=True)
                if i:
                    edges = handover.continued(edges, checkpoints[i - 1], checkpoints[i])
                q, _ = X.run_state_only(X.edge_totals(edges), checkpoints[i])
                X.await_done(q)
                states = [p["stateOperators"][0]["numShufflePartitions"] for p in q.recentProgress if p["stateOperators"]]
                assert set(states) <= {partitions}
            want = clickstream(clicks.where(" OR ".join(f"({p})" for p in parts[:i + 1]))).select(*S.EDGE_COLUMNS)
            assert rows(X.state_edges(spark, checkpoints[i])) == rows(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert handover.read_files(spark, checkpoints[0]).count() == 2
    assert handover.last_committed(spark, at("none")) is None and handover.read_files(spark, at("none")).count() == 0
    assert handover.starting_offsets(spark, at("none")) == "earliest"
    assert handover.remaining_text(spark, at("a b"), checkpoints[0], since="2000-01-01 00:00:00").isStreaming
    clicks.unpersist()


def test_continues_on_the_command_line(spark, tmpdir_path, capsys):
    from navedge.__main__ import main
    clicks = load_clicks(spark, SF_SMALL)
    at = lambda *p: os.path.join(tmpdir_path, *p)
    common = ["--source-dir", at("src"), "--trigger", "availableNow", "--escaped"]
    _source(clicks, at("src"), "event_id < 500")
    assert main(["stream", at("k1"), "--out", at("log"), *common]) == 0
    _source(clicks, at("src"), "event_id >= 500")
    assert main(["stream", at("k2"), "--out", at("t"), "--route", "table", "--buckets", "4", "--continues", at("k1"), "--read-since", "2000-01-01", *common]) == 0
    from navedge.sinks.table import read_table
    assert rows(read_table(spark, at("t")).select(*S.EDGE_COLUMNS)) == rows(clickstream(clicks).select(*S.EDGE_COLUMNS))
    assert main(["stream", at("k3"), "--out", at("x"), "--route", "append", "--continues", at("k1"), *common]) == 2
    assert "--continues is for" in capsys.readouterr().err
