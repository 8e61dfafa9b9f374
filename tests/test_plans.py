"""Plan shape: pruning, pushdown, top-k, shuffle count, no Python on the core path."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from navedge.operators.flow import flow_one_pass
from navedge.plans import questions as Q
from navedge.sources.events import load_edges
from navedge.plans.catalog import QUERIES

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow")


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def edges(spark):
    import tempfile
    path = tempfile.mkdtemp(prefix="navedge-edges-") + "/edges"
    load_edges(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_q1_prunes_columns_and_uses_top_k(edges):
    p = plan(Q.top_articles(edges))
    assert "ReadSchema: struct<curr:string,n:bigint>" in p
    assert "TakeOrderedAndProject" in p


def test_q3_q4_push_filters(edges):
    assert "EqualTo(prev,other-twitter)" in plan(Q.top_from_referer(edges))
    assert "EqualTo(type,redlink)" in plan(Q.missing_pages(edges))


def test_q6_filter_reaches_both_scans(edges):
    p = plan(Q.article_flow(edges))
    assert "EqualTo(curr,Deaths_in_2015)" in p and "EqualTo(prev,Deaths_in_2015)" in p


def test_q5_one_pass_has_one_hash_shuffle(edges):
    p = plan(flow_one_pass(edges))
    assert p.count("hashpartitioning") == 1
    assert sum(1 for line in p.splitlines() if re.match(r"\(\d+\) Scan parquet", line)) == 1


def test_questions_one_pass_moves_edges_once(edges):
    p = plan(Q.questions_one_pass(edges))
    assert sum(1 for line in p.splitlines() if re.match(r"\(\d+\) Scan parquet", line)) == 1
    assert [re.search(r"hashpartitioning\((\w+)#", x)[1] for x in p.splitlines() if "Arguments: hashpartitioning" in x] == ["question"] * 2
    # the second moves what a limit inside each task leaves
    tree = p[:p.index("\n\n")]
    assert tree.index("WindowGroupLimit") < tree.rindex("WindowGroupLimit") < tree.rindex("Exchange")


def test_shared_referers_never_gathers_a_hot_referrer(spark, edges):
    p = plan(Q.shared_referers(edges))
    windows = [line for line in p.splitlines() if line.startswith("Arguments: [row_number()")]
    assert len(windows) == 2 and any("_nv_salt" in w for w in windows)
    hot = spark.range(30000).selectExpr("'hot' prev", "concat('c', id % 9000) curr", "'link' type", "id % 500 n")
    both = edges.unionByName(hot).unionByName(spark.createDataFrame([(None, "x", "y", 1), ("hot", None, None, None)], edges.schema))
    row = Q.shared_referers(both, k=4).where("prev = 'hot'").first()
    assert (row.in_rows, row.out_rows) == (30000, 30001) and [e.n for e in row.in_edges] == [499] * 4
    assert [e.curr for e in row.out_edges] == sorted(f"c{i % 9000}" for i in range(30000) if i % 500 == 499)[:4]
    into = Q.shared_referers(both, into="Deaths_in_2015", out="%", k=2)
    assert into.count() == edges.where("curr LIKE 'Deaths_in_2015' AND prev IS NOT NULL").select("prev").distinct().count()


def test_lag_never_partitions_by_user_alone(spark):
    from navedge.sources.events import load_clicks
    p = plan(load_clicks(spark, SF_SMALL))
    assert "rangepartitioning(user_id" in p
    assert "hashpartitioning(user_id#" in p
    for line in p.splitlines():
        if line.startswith("Arguments: hashpartitioning(user_id"):
            assert "_nv_slice" in line or "_nv_group" in line


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.startswith("stream_")))
def test_no_python_nodes(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert not any(node in p for node in PYTHON_NODES)
