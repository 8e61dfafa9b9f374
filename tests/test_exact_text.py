"""Awkward titles and nulls through every wire form."""

import os

import pytest

from conftest import rows
from navedge import schema as S
from navedge.functions import parse as P
from navedge.plans import sql_surface
from navedge.sources import files

TITLES = ["", " a ", "\"quoted\"", "\"", "back\\slash", "\\N", "\\E", "\\\\t", "tab\there", "line\nend", "cr\r", "a,b", "'", "null", None, "x"]


@pytest.fixture(scope="module")
def edges(spark):
    data = [(a, b, "link", i) for i, (a, b) in enumerate(zip(TITLES, TITLES[::-1]))] + [("a", "b", None, None)]
    return spark.createDataFrame(data, S.EDGE_SCHEMA)


def test_escaped_messages(spark, edges):
    sent = P.tab_message(edges, escaped=True)
    assert rows(P.parse_permissive(sent, strip=False, escaped=True)) == rows(edges)
    assert rows(P.parse_strict(sent, escaped=True)) == rows(edges)


def test_json_messages(spark, edges):
    assert rows(P.parse_json(P.json_message(edges))) == rows(edges)


def test_escaped_tsv_and_text(spark, edges, tmpdir_path):
    for header in (False, True):
        path = files.write_tsv(edges, os.path.join(tmpdir_path, f"t{header}"), header=header, escaped=True)
        back = files.read_tsv(spark, path, escaped=True)
        assert rows(files.drop_header(back) if header else back) == rows(edges)
    path = os.path.join(tmpdir_path, "text")
    P.tab_message(edges, escaped=True).write.text(path)
    assert rows(files.read_text_edges(spark, path, escaped=True)) == rows(edges)


def test_csv(spark, edges, tmpdir_path):
    path = files.write_csv(edges.where("prev IS NULL OR (prev <> '\\\\N' AND prev NOT LIKE '%\r%')")
                           .where("curr IS NULL OR (curr <> '\\\\N' AND curr NOT LIKE '%\r%')"), os.path.join(tmpdir_path, "csv"))
    want = [r for r in rows(edges) if "\\N" not in r and "cr\r" not in r]
    assert rows(files.read_csv(spark, path)) == want


def test_strict_text_scan_fails_in_any_mode(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "bad.tsv"), "w") as f:
        f.write("a\tb\tlink\t3\nshort\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            with pytest.raises(Exception, match="not an edge"):
                files.read_text_edges(spark, tmpdir_path).count()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_strict_parser_rejects_a_trailing_line_feed(spark):
    df = spark.createDataFrame([("a\tb\tc\t5\n",), ("a\tb\tc\t5",)], "value string")
    assert P.parse_strict(df).count() == 1


def test_sql_values_are_bound(spark, edges):
    df = spark.createDataFrame([("O'Brien", "x", "link", 2), ("x", "y", "link", 5)], S.EDGE_SCHEMA)
    assert [tuple(r) for r in sql_surface.question_sql(df, "q3", referer="O'Brien").collect()] == [("x", 2)]
    assert sql_surface.question_sql(df, "q3", referer="x' OR '1'='1").count() == 0
