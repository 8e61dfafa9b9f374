"""Edge rows of FIXTURES.md section 3, one test per table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from navedge import schema as S
from navedge.functions.parse import (encode_message, parse_avro, parse_json, parse_permissive,
                                     parse_strict, strip_markup)
from navedge.operators.flow import flow_join, flow_one_pass
from navedge.operators.keyed import replace_into
from navedge.operators.window import sliding_counts
from navedge.sources.files import drop_header, read_text_edges, read_tsv


def _write_lines(dirpath, lines, name="part-0.tsv"):
    p = os.path.join(dirpath, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return dirpath


def _edges(spark, data):
    return spark.createDataFrame(data, S.EDGE_SCHEMA)


def _messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


# 3a ---------------------------------------------------------------------------
def test_tsv_scan_quotes_off_permissive(spark, tmpdir_path):
    lines = ['other-search\t"Weird_Al"_Yankovic\texternal\t10', "a\tb\tlink\tzz", "a\tb",
             '"x\ty\tlink\t3', "", "prev\tcurr\ttype\tn", "a\tb\tc\t4\textra"]
    df = read_tsv(spark, _write_lines(tmpdir_path, lines))
    got = rows(df)
    expect = sorted([
        ("other-search", '"Weird_Al"_Yankovic', "external", 10),
        ("a", "b", "link", None), ("a", "b", None, None), ('"x', "y", "link", 3),
        ("prev", "curr", "type", None), ("a", "b", "c", 4)], key=repr)
    assert got == expect
    no_header = rows(drop_header(df))
    assert ("prev", "curr", "type", None) not in no_header
    assert len(no_header) == 5


def test_text_scan_fails_on_bad_row(spark, tmpdir_path):
    ok = read_text_edges(spark, _write_lines(tmpdir_path, ["a\tb\tc\t4"]))
    assert rows(ok) == [("a", "b", "c", 4)]
    bad_dir = os.path.join(tmpdir_path, "bad")
    os.makedirs(bad_dir)
    bad = read_text_edges(spark, _write_lines(bad_dir, ["a\tb\tc\tzz"]))
    with pytest.raises(Exception):
        bad.collect()
    for i, line in enumerate(["a\tb\tc\t 5 ", "a\tb\tc\t5 ", "a\tb\tc\t5.0", "a\tb\tc\t"]):
        padded_dir = os.path.join(tmpdir_path, f"padded{i}")
        os.makedirs(padded_dir)
        with pytest.raises(Exception):
            read_text_edges(spark, _write_lines(padded_dir, [line])).collect()
    short_dir = os.path.join(tmpdir_path, "short")
    os.makedirs(short_dir)
    with pytest.raises(Exception):
        read_text_edges(spark, _write_lines(short_dir, ["a\tb"])).collect()


# 3b ---------------------------------------------------------------------------
def test_strict_parser_keeps_and_drops(spark):
    kept = ["a\tb\tc\t5", "a\tb\tc\t5\t", "a\tb\tc\t+5", "a\tb\tc\t-5", "a\tb\t\t5", "\t\t\t7"]
    dropped = ["a\tb\tc\t", "a\tb\tc\t 5", "a\tb\tc\t5.0", "", "a\tb\tc\t99999999999999999999",
               "a\tb\tc\t5\tz"]
    got = rows(parse_strict(_messages(spark, kept + dropped)))
    assert got == sorted([("a", "b", "c", 5), ("a", "b", "c", 5), ("a", "b", "c", 5),
                          ("a", "b", "c", -5), ("a", "b", "", 5), ("", "", "", 7)], key=repr)


def test_permissive_parser_keeps_everything(spark):
    got = rows(parse_permissive(_messages(spark, ["a\tb\tc\tzz", "a\tb", "[en]:a\tb\tc\t[n]:4"])))
    assert got == sorted([("a", "b", "c", None), ("a", "b", None, None), ("a", "b", "c", 4)],
                         key=repr)


def test_binary_values_parse(spark):
    df = spark.createDataFrame([(bytearray(b"a\tb\tc\t5"),)], "value binary")
    assert rows(parse_strict(df)) == [("a", "b", "c", 5)]
    assert rows(parse_permissive(df)) == [("a", "b", "c", 5)]


# 3c ---------------------------------------------------------------------------
def test_strip_markup(spark):
    df = _messages(spark, ["[en]:Foo [x]:b [a-b]:c"])
    assert df.select(strip_markup("value")).first()[0] == "Foo b [a-b]:c"


# 3d ---------------------------------------------------------------------------
def test_json_permissive(spark):
    texts = ['{"prev":"a","curr":"b","link":"l","n":3}', "bad", '{"prev":"a","n":"x"}',
             '{"prev":"a","n":"7"}', '{"prev":"a","n":7.5}', '{"prev":"a","extra":1}', None]
    got = parse_json(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert got.columns == S.EDGE_COLUMNS
    assert rows(got) == sorted([("a", "b", "l", 3), (None, None, None, None)] +
                               [("a", None, None, None)] * 4 + [(None, None, None, None)], key=repr)
    strict = parse_json(spark.createDataFrame([(t,) for t in texts], "value string"), strict=True)
    assert strict.count() == 5


# 3e ---------------------------------------------------------------------------
FLOW_CASES = [
    ([("x", "A", "link", 4), ("A", "B", "link", 3)], [("A", 4, 3, 0.75)]),
    ([("A", "A", "link", 2)], [("A", 2, 2, 1.0)]),
    ([("x", "A", "link", None), ("A", "y", "link", 3)], [("A", None, 3, None)]),
    ([("x", "A", "link", 0), ("A", "y", "link", 3)], [("A", 0, 3, None)]),
    ([("x", None, "link", 4), (None, "y", "link", 3)], []),
]


@pytest.mark.parametrize("edges,expect", FLOW_CASES)
def test_inflow_outflow_forms_agree(spark, edges, expect):
    e = _edges(spark, edges)
    assert rows(flow_one_pass(e)) == expect
    assert rows(flow_join(e)) == expect


# 3f ---------------------------------------------------------------------------
def test_like_is_not_equality(spark):
    df = spark.createDataFrame([("Deaths-in-2015",), ("Deaths_in_2015x",), ("Deaths_in_2015",)], "t string")
    hit = sorted(r[0] for r in df.where(F.col("t").like("Deaths_in_2015")).collect())
    assert hit == ["Deaths-in-2015", "Deaths_in_2015"]


# 3g ---------------------------------------------------------------------------
def test_replace_into(spark):
    target = _edges(spark, [("a", "b", "l", 1), ("c", "d", "l", 2)])
    batch = _edges(spark, [("a", "b", "l", 9), ("e", "f", "l", 3)])
    once = replace_into(target, batch)
    expect = sorted([("a", "b", "l", 9), ("c", "d", "l", 2), ("e", "f", "l", 3)], key=repr)
    assert rows(once) == expect
    assert rows(replace_into(once, batch)) == expect


def test_replace_into_order_column_decides(spark):
    target = spark.createDataFrame([], "prev string, curr string, type string, n bigint, seq int")
    batch = spark.createDataFrame([("a", "b", "l", 1, 1), ("a", "b", "l", 2, 2)],
                                  "prev string, curr string, type string, n bigint, seq int")
    assert rows(replace_into(target, batch, order="seq")) == [("a", "b", "l", 2, 2)]
    batch2 = spark.createDataFrame([("a", "b", "l", 1, 2), ("a", "b", "l", 2, 1)],
                                   "prev string, curr string, type string, n bigint, seq int")
    assert rows(replace_into(target, batch2, order="seq")) == [("a", "b", "l", 1, 2)]


def test_replace_into_null_keys(spark):
    target = _edges(spark, [(None, "b", "l", 1)])
    batch = _edges(spark, [(None, "b", "l", 5)])
    assert rows(replace_into(target, batch)) == [(None, "b", "l", 5)]


# 3h ---------------------------------------------------------------------------
def test_sliding_window_bounds(spark):
    ts = [dt.datetime(2024, 1, 1, 0, 8), dt.datetime(2024, 1, 1, 0, 12)]
    df = spark.createDataFrame([("k", t) for t in ts], "key string, ts timestamp_ntz")
    got = rows(sliding_counts(df, "ts", ["key"]).select(
        F.date_format("window_start", "HH:mm"), F.date_format("window_end", "HH:mm"), "count"))
    assert got == [("00:02", "00:12", 1), ("00:07", "00:17", 2), ("00:12", "00:22", 1)]


# 3i ---------------------------------------------------------------------------
def test_sink_message_prints_null(spark):
    df = _edges(spark, [("a", None, "l", 4)])
    assert encode_message(df).first()[0] == "a:null:l:4"


def test_avro_is_gated(spark):
    schema = ('{"type":"record","name":"Click","fields":[{"name":"prev","type":"string"},'
              '{"name":"curr","type":"string"},{"name":"link","type":"string"},'
              '{"name":"n","type":"long"}]}')
    df = spark.createDataFrame([(bytearray(b"x"),)], "value binary")
    try:
        out = parse_avro(df, schema)
    except RuntimeError as e:
        assert "spark-avro" in str(e)
    else:
        assert out.columns == S.EDGE_COLUMNS


def test_replace_into_order_outside_target_and_ties(spark):
    target = _edges(spark, [("a", "b", "l", 1)])
    batch = spark.createDataFrame([("a", "b", "l", 7, 3), ("a", "b", "l", 9, 3), ("a", "b", "l", 5, 2)],
                                  "prev string, curr string, type string, n bigint, seq int")
    got = replace_into(target, batch, order="seq")
    assert got.columns == S.EDGE_COLUMNS
    # equal order values: the larger remaining value wins, every time
    assert rows(got) == [("a", "b", "l", 9)]
