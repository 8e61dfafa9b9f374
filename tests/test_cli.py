"""The command line runs the batch questions and the file-stream route."""

import os

from conftest import SF_SMALL, rows
from navedge.__main__ import main
from navedge.functions.parse import tab_message
from navedge.plans import questions as Q
from navedge.sources.events import clickstream, load_clicks
from navedge.sources.files import write_tsv
from navedge.sinks.versioned import read_latest_snapshot


def test_questions_command(spark, tmpdir_path):
    edges = clickstream(load_clicks(spark, SF_SMALL))
    src = write_tsv(edges, os.path.join(tmpdir_path, "edges"), header=True)
    out = os.path.join(tmpdir_path, "out")
    assert main(["questions", "--input", src, "--out", out]) == 0
    assert rows(spark.read.parquet(f"{out}/top_articles")) == rows(Q.top_articles(edges))
    assert rows(spark.read.parquet(f"{out}/inflow_outflow")) == rows(Q.inflow_outflow(edges))
    assert rows(spark.read.parquet(f"{out}/both_lists")) == rows(Q.both_lists(edges))


def test_stream_command_on_files(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "msgs")
    tab_message(clicks.repartition(3)).write.text(src)
    out = os.path.join(tmpdir_path, "answers")
    code = main(["stream", "--source-dir", src, os.path.join(tmpdir_path, "ckpt"), "--out", out,
                 "--trigger", "availableNow", "--max-files-per-trigger", "1",
                 "--message-format", "strict", "--route", "complete", "--k", "3"])
    assert code == 0
    edges = clickstream(clicks)
    assert rows(read_latest_snapshot(spark, f"{out}/top_referers")) == rows(Q.top_referers(edges, 3))
    assert rows(read_latest_snapshot(spark, f"{out}/article_flow")) == rows(Q.article_flow(edges))


def test_stream_command_needs_checkpoint():
    assert main(["stream", "h:9092", "subscribe", "clickers", "--out", "/nonexistent"]) == 2


def test_changelog_route_then_questions(spark, tmpdir_path):
    clicks = load_clicks(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "msgs")
    tab_message(clicks.repartition(3)).write.text(src)
    log = os.path.join(tmpdir_path, "log")
    assert main(["stream", "--source-dir", src, os.path.join(tmpdir_path, "ckpt"), "--out", log,
                 "--trigger", "availableNow", "--max-files-per-trigger", "1",
                 "--route", "changelog"]) == 0
    out = os.path.join(tmpdir_path, "answers")
    assert main(["questions", "--input", log, "--input-format", "changelog", "--out", out]) == 0
    edges = clickstream(clicks)
    assert rows(spark.read.parquet(f"{out}/inflow_outflow")) == rows(Q.inflow_outflow(edges))
    assert rows(spark.read.parquet(f"{out}/top_referers")) == rows(Q.top_referers(edges))


def test_conf_command(capsys):
    from navedge.__main__ import parse_bytes
    assert parse_bytes("100T") == 100 << 40 and parse_bytes("512g") == 512 << 30
    assert main(["conf", "--input-bytes", "100T", "--cores", "8000"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert "--conf spark.sql.shuffle.partitions=409600" in out


def test_append_fanout_and_console_routes(spark, tmpdir_path, capfd):
    from navedge.sources.files import read_csv
    clicks = load_clicks(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "msgs")
    tab_message(clicks.repartition(3), escaped=True).write.text(src)
    want = rows(clicks.select("prev", "curr", "type", "n"))
    at = lambda *parts: os.path.join(tmpdir_path, *parts)
    common = ["--trigger", "availableNow", "--escaped"]
    assert main(["stream", "--source-dir", src, at("k1"), "--out", at("a"), "--route", "append", *common]) == 0
    assert rows(spark.read.parquet(at("a")).select("prev", "curr", "type", "n")) == want
    assert main(["stream", "--source-dir", src, at("k2"), "--out", at("f"), "--route", "fanout", *common]) == 0
    assert rows(read_csv(spark, at("f", "csv")).select("prev", "curr", "type", "n")) == want
    assert main(["stream", "--source-dir", src, at("k3"), "--route", "console", *common]) == 0
