"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracles.

Each query reads the driver tables under ``sf_dir`` (or files Spark writes
from them) and runs one operator of the library over all of it. The oracle
dictionary holds DuckDB SQL over the same tables with equal column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from navedge import schema as S
from navedge.plans import questions as Q
from navedge.sources.events import load_clicks, load_edges, with_fixture

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _ord(*cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols)


def _top_sum_sql(key: str, label: str, total: str, k: int, where: str = "") -> str:
    return with_fixture(f"""
SELECT {key} AS {label}, CAST(SUM(n) AS BIGINT) AS {total}
FROM clickstream {where}
GROUP BY {key}
ORDER BY {total} DESC NULLS LAST, {_ord(label)}
LIMIT {k}""")


def _edges_like_sql(col: str, pattern: str, k: int) -> str:
    return (f"SELECT prev, curr, type, n FROM clickstream WHERE {col} LIKE '{pattern}' "
            f"ORDER BY n DESC NULLS LAST, {_ord('prev', 'curr', 'type')} LIMIT {k}")


_INTO = _edges_like_sql("curr", S.DEFAULT_ARTICLE_PATTERN, S.DEFAULT_ARTICLE_EDGES_K)
_OUT = _edges_like_sql("prev", S.DEFAULT_ARTICLE_PATTERN, S.DEFAULT_ARTICLE_EDGES_K)
_LISTS = f", t2 AS ({_INTO}), t1 AS ({_OUT})\n"
_FLOW_SQL = """, i AS (SELECT curr AS Article, CAST(SUM(n) AS BIGINT) AS in_count FROM clickstream GROUP BY curr),
o AS (SELECT prev AS link_clicked, CAST(SUM(n) AS BIGINT) AS out_count FROM clickstream GROUP BY prev),
r AS (SELECT Article, in_count, out_count,
        CASE WHEN in_count = 0 THEN NULL ELSE CAST(out_count AS DOUBLE) / in_count END AS ratio
      FROM i JOIN o ON i.Article = o.link_clicked)
"""


# Fixture ---------------------------------------------------------------------
@register("clickstream_build", with_fixture("SELECT prev, curr, type, n FROM clickstream"))
def clickstream_build(spark, sf_dir):
    return load_edges(spark, sf_dir)


@register("clicks_build", with_fixture("SELECT event_id, ts, prev, curr, type, n FROM clicks"))
def clicks_build(spark, sf_dir):
    return load_clicks(spark, sf_dir)


# Questions 1-4 ---------------------------------------------------------------
@register("q1_top_articles", _top_sum_sql("curr", *S.Q1_COLUMNS, S.DEFAULT_TOP_ARTICLES_K))
def q1_top_articles(spark, sf_dir):
    return Q.top_articles(load_edges(spark, sf_dir))


@register("q2_top_referers", _top_sum_sql("prev", *S.Q2_COLUMNS, S.DEFAULT_TOP_REFERERS_K))
def q2_top_referers(spark, sf_dir):
    return Q.top_referers(load_edges(spark, sf_dir))


@register("q3_top_from_referer", _top_sum_sql(
    "curr", *S.Q3_COLUMNS, S.DEFAULT_FROM_REFERER_K, f"WHERE prev = '{S.DEFAULT_REFERER}'"))
def q3_top_from_referer(spark, sf_dir):
    return Q.top_from_referer(load_edges(spark, sf_dir))


@register("q4_missing_pages", _top_sum_sql(
    "curr", *S.Q4_COLUMNS, S.DEFAULT_MISSING_PAGES_K, f"WHERE type = '{S.DEFAULT_MISSING_TYPE}'"))
def q4_missing_pages(spark, sf_dir):
    return Q.missing_pages(load_edges(spark, sf_dir))


# Totals ----------------------------------------------------------------------
@register("page_views", with_fixture(
    "SELECT curr AS Article, CAST(SUM(n) AS BIGINT) AS in_count FROM clickstream GROUP BY curr"))
def page_views(spark, sf_dir):
    return Q.page_views(load_edges(spark, sf_dir))


@register("link_clicks", with_fixture(
    "SELECT prev AS link_clicked, CAST(SUM(n) AS BIGINT) AS out_count FROM clickstream GROUP BY prev"))
def link_clicks(spark, sf_dir):
    return Q.link_clicks(load_edges(spark, sf_dir))


@register("curr_totals", with_fixture(
    "SELECT curr, CAST(SUM(n) AS BIGINT) AS total FROM clickstream GROUP BY curr "
    f"ORDER BY total DESC NULLS LAST, {_ord('curr')}"))
def curr_totals(spark, sf_dir):
    return Q.curr_totals(load_edges(spark, sf_dir))


@register("curr_row_counts", with_fixture(
    "SELECT curr, COUNT(*) AS count FROM clickstream GROUP BY curr"))
def curr_row_counts(spark, sf_dir):
    from navedge.operators.aggregate import count_by
    return count_by(load_edges(spark, sf_dir), "curr")


@register("total_rows", with_fixture("SELECT COUNT(*) AS total_rows FROM clickstream"))
def total_rows(spark, sf_dir):
    from navedge.operators.aggregate import total_rows as tr
    return tr(load_edges(spark, sf_dir))


# Questions 5-6 ---------------------------------------------------------------
@register("q5_inflow_outflow", with_fixture(
    _FLOW_SQL + "SELECT Article, in_count, out_count, ratio FROM r "
    f"ORDER BY in_count DESC NULLS LAST, {_ord('Article', 'out_count', 'ratio')}"))
def q5_inflow_outflow(spark, sf_dir):
    return Q.inflow_outflow(load_edges(spark, sf_dir))


@register("q6_article_flow", with_fixture(
    _FLOW_SQL + f"SELECT Article, in_count, out_count, ratio FROM r WHERE Article = '{S.DEFAULT_ARTICLE}'"))
def q6_article_flow(spark, sf_dir):
    return Q.article_flow(load_edges(spark, sf_dir))


# Questions 7-9 ---------------------------------------------------------------
@register("q7_into_article", with_fixture(_INTO))
def q7_into_article(spark, sf_dir):
    return Q.into_article(load_edges(spark, sf_dir))


@register("q8_out_of_article", with_fixture(_OUT))
def q8_out_of_article(spark, sf_dir):
    return Q.out_of_article(load_edges(spark, sf_dir))


@register("q9_union", with_fixture(_LISTS + "SELECT * FROM t1 UNION SELECT * FROM t2"))
def q9_union(spark, sf_dir):
    return Q.both_lists(load_edges(spark, sf_dir))


_RANK = "ROW_NUMBER() OVER (ORDER BY n DESC NULLS LAST, " + _ord("prev", "curr", "type") + ") AS rank"


@register("q9_side_by_side", with_fixture(
    _LISTS + f", r2 AS (SELECT {_RANK}, * FROM t2), r1 AS (SELECT {_RANK}, * FROM t1) "
    "SELECT COALESCE(r2.rank, r1.rank) AS rank, "
    "r2.prev AS in_prev, r2.curr AS in_curr, r2.type AS in_type, r2.n AS in_n, "
    "r1.prev AS out_prev, r1.curr AS out_curr, r1.type AS out_type, r1.n AS out_n "
    "FROM r2 FULL OUTER JOIN r1 ON r2.rank = r1.rank"))
def q9_side_by_side(spark, sf_dir):
    return Q.both_lists_side_by_side(load_edges(spark, sf_dir))


# Joined forms of question 9: with 20 edges a list both have rows on the driver's tables.
PAIR_K = 20


def _edges_text_sql(alias: str) -> str:
    text = "coalesce(prev, 'null') || '>' || coalesce(curr, 'null') || ':' || coalesce(type, 'null') || ':' || coalesce(CAST(n AS VARCHAR), 'null')"
    return f"string_agg({text}, '; ' ORDER BY n DESC NULLS LAST, {_ord('prev', 'curr', 'type')}) AS {alias}"


def _pair_sql(into_key: str, out_key: str, name: str) -> str:
    return with_fixture(
        f", t2 AS ({_edges_like_sql('curr', S.DEFAULT_ARTICLE_PATTERN, PAIR_K)}), "
        f"t1 AS ({_edges_like_sql('prev', S.DEFAULT_ARTICLE_PATTERN, PAIR_K)}), "
        f"i AS (SELECT {into_key} AS k, {_edges_text_sql('in_edges')} FROM t2 GROUP BY {into_key}), "
        f"o AS (SELECT {out_key} AS k, {_edges_text_sql('out_edges')} FROM t1 GROUP BY {out_key}) "
        f"SELECT i.k AS {name}, in_edges, out_edges FROM i JOIN o ON i.k = o.k")


def _as_text(pairs: DataFrame) -> DataFrame:
    return pairs.select(pairs.columns[0], *[Q.edge_text(c).alias(c) for c in ("in_edges", "out_edges")])


@register("q9_paths", _pair_sql("curr", "prev", "article"))
def q9_paths(spark, sf_dir):
    return _as_text(Q.two_step_paths(load_edges(spark, sf_dir), k=PAIR_K))


@register("q9_same_referer", _pair_sql("prev", "prev", "prev"))
def q9_same_referer(spark, sf_dir):
    return _as_text(Q.same_referer(load_edges(spark, sf_dir), k=PAIR_K))


SHARED_K = 3


def _shared_sql() -> str:
    text = "coalesce(prev, 'null') || '>' || coalesce(curr, 'null') || ':' || coalesce(type, 'null') || ':' || coalesce(CAST(n AS VARCHAR), 'null')"
    order = f"n DESC NULLS LAST, {_ord('prev', 'curr', 'type')}"
    side = lambda name, col: (
        f"{name}_all AS (SELECT *, row_number() OVER (PARTITION BY prev ORDER BY {order}) AS r FROM clickstream WHERE {col} LIKE '%' AND prev IS NOT NULL), "
        f"{name}_side AS (SELECT prev, count(*) AS {name}_rows, CAST(sum(n) AS BIGINT) AS {name}_hits, "
        f"string_agg({text}, '; ' ORDER BY r) FILTER (r <= {SHARED_K}) AS {name}_edges FROM {name}_all GROUP BY prev)")
    return with_fixture(f", {side('in', 'curr')}, {side('out', 'prev')} SELECT prev, in_rows, in_hits, out_rows, out_hits, in_edges, out_edges "
                        "FROM in_side JOIN out_side USING (prev)")


@register("q9_shared_referers", _shared_sql())
def q9_shared_referers(spark, sf_dir):
    """Both lists over all edges, joined on the referrer."""
    found = Q.shared_referers(load_edges(spark, sf_dir), k=SHARED_K)
    return found.withColumns({c: Q.edge_text(c) for c in ("in_edges", "out_edges")})


EDGES_WHERE_PREDICATE = "type = 'link' AND n > 1"


@register("edges_where", with_fixture(
    f"SELECT prev, curr, type, n FROM clickstream WHERE {EDGES_WHERE_PREDICATE}"))
def edges_where(spark, sf_dir):
    return Q.edges_where(load_edges(spark, sf_dir), EDGES_WHERE_PREDICATE)


# Sources and parsers ---------------------------------------------------------
# Each of these writes the derived clicks/edges with Spark into the shared
# scratch folder in the wire format, then reads them back with the source or
# parser under test, so their work grows with the tables.
_CLICK_ROWS_SQL = with_fixture("SELECT prev, curr, type, n FROM clicks")
_EDGES_SQL = with_fixture("SELECT prev, curr, type, n FROM clickstream")


def _staged_edges(spark, sf_dir, header=False):
    from navedge.session import scratch_path
    from navedge.sources.files import write_tsv
    return write_tsv(load_edges(spark, sf_dir), scratch_path(spark, "edges-tsv"), header=header, escaped=True)


@register("tsv_scan", _EDGES_SQL)
def tsv_scan(spark, sf_dir):
    from navedge.sources.files import read_tsv
    return read_tsv(spark, _staged_edges(spark, sf_dir), escaped=True)


@register("drop_header", _EDGES_SQL)
def drop_header(spark, sf_dir):
    from navedge.sources.files import drop_header as dh, read_tsv
    return dh(read_tsv(spark, _staged_edges(spark, sf_dir, header=True), escaped=True))


@register("text_scan", _EDGES_SQL)
def text_scan(spark, sf_dir):
    from navedge.sources.files import read_text_edges
    return read_text_edges(spark, _staged_edges(spark, sf_dir), escaped=True)


def _messages(spark, sf_dir, fmt="tab"):
    from navedge.sources.messages import stage_messages
    return spark.read.text(stage_messages(load_clicks(spark, sf_dir), fmt))


@register("parse_permissive", _CLICK_ROWS_SQL)
def parse_permissive(spark, sf_dir):
    from navedge.functions.parse import parse_permissive as pp
    return pp(_messages(spark, sf_dir), strip=False, escaped=True)


@register("parse_strict", _CLICK_ROWS_SQL)
def parse_strict(spark, sf_dir):
    from navedge.functions.parse import parse_strict as ps
    return ps(_messages(spark, sf_dir), escaped=True)


@register("parse_json", _CLICK_ROWS_SQL)
def parse_json(spark, sf_dir):
    from navedge.functions.parse import parse_json as pj
    return pj(_messages(spark, sf_dir, "json"))


@register("strip_markup", _CLICK_ROWS_SQL)
def strip_markup(spark, sf_dir):
    """Messages whose every field carries a ``[<link kind>]:`` marker, parsed and cleaned."""
    from pyspark.sql import functions as F
    from navedge.functions.parse import escape_field, parse_permissive as pp
    from navedge.sources.files import write_text
    from navedge.session import scratch_path
    mark = F.coalesce(F.concat(F.lit("["), F.col("type"), F.lit("]:")), F.lit("[none]:"))
    marked = load_clicks(spark, sf_dir).select(
        F.concat_ws("\t", *[F.concat(mark, escape_field(c)) for c in S.EDGE_COLUMNS]).alias("value"))
    path = write_text(marked, scratch_path(spark, "messages-marked"))
    return pp(spark.read.text(path), strip=True, escaped=True)


@register("encode_message", with_fixture(
    "SELECT concat_ws(':', coalesce(prev, 'null'), coalesce(curr, 'null'), coalesce(type, 'null'), "
    "coalesce(CAST(n AS VARCHAR), 'null')) AS value FROM clicks"))
def encode_message(spark, sf_dir):
    from navedge.functions.parse import encode_message as em
    return em(load_clicks(spark, sf_dir))


def _escaped_sql(col: str) -> str:
    """The escaped wire form of a text column."""
    inner = f"replace({col}, '\\', '\\\\')"
    for code, letter in ((9, "t"), (10, "n"), (13, "r")):
        inner = f"replace({inner}, chr({code}), '\\{letter}')"
    return f"CASE WHEN {col} IS NULL THEN '\\N' WHEN {col} = '' THEN '\\E' ELSE {inner} END"


@register("token_counts", with_fixture(
    ", m AS (SELECT " + " || chr(9) || ".join(
        f"({_escaped_sql(c)})" for c in ("prev", "curr", "type", "CAST(n AS VARCHAR)")) + " AS v "
    "FROM clicks) SELECT value, COUNT(*) AS count FROM "
    "(SELECT unnest(string_split(v, chr(9))) AS value FROM m) GROUP BY value"))
def token_counts(spark, sf_dir):
    from navedge.operators.aggregate import token_counts as tc
    return tc(_messages(spark, sf_dir), "value", "\t")


def _stacked_sql() -> str:
    """Questions 1-4 one below the other, written apart from the statements under test."""
    asked = (("q1", "curr", S.DEFAULT_TOP_ARTICLES_K, "TRUE"), ("q2", "prev", S.DEFAULT_TOP_REFERERS_K, "TRUE"),
             ("q3", "curr", S.DEFAULT_FROM_REFERER_K, f"prev = '{S.DEFAULT_REFERER}'"),
             ("q4", "curr", S.DEFAULT_MISSING_PAGES_K, f"type = '{S.DEFAULT_MISSING_TYPE}'"))
    ranked = " UNION ALL ".join(
        f"SELECT '{q}' AS question, {k} AS most, {key} AS label, CAST(SUM(n) AS BIGINT) AS total FROM clickstream WHERE {only} GROUP BY {key}"
        for q, key, k, only in asked)
    return with_fixture(
        f", sums AS ({ranked}), places AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY question "
        f"ORDER BY total DESC NULLS LAST, {_ord('label')}) AS place FROM sums) "
        "SELECT question, label, total FROM places WHERE place <= most")


@register("sql_surface", _stacked_sql())
def sql_surface(spark, sf_dir):
    from navedge.plans.sql_surface import stacked_questions
    return stacked_questions(load_edges(spark, sf_dir))


@register("questions_one_pass", _stacked_sql())
def questions_one_pass(spark, sf_dir):
    return Q.questions_one_pass(load_edges(spark, sf_dir))


@register("q5_bucketed_tables", ORACLE["q5_inflow_outflow"])
def q5_bucketed_tables(spark, sf_dir):
    """Question 5 from stored totals, bucketed and sorted by article: the join reads both without an exchange."""
    import uuid
    from navedge.session import scratch_path
    from navedge.sinks.table import bucketed_flow, save_bucketed
    staged = scratch_path(spark, "edges")
    load_edges(spark, sf_dir).write.parquet(staged)
    edges, tag = spark.read.parquet(staged), uuid.uuid4().hex[:8]
    save_bucketed(Q.page_views(edges), f"navedge_in_{tag}", "Article", 8)
    save_bucketed(Q.link_clicks(edges), f"navedge_out_{tag}", "link_clicked", 8)
    return bucketed_flow(spark, f"navedge_in_{tag}", f"navedge_out_{tag}")


# Windows ---------------------------------------------------------------------
WINDOW_ORACLE_SQL = """
WITH b AS (SELECT event_type,
    time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01 00:02:00') AS s FROM events),
w AS (SELECT event_type, s AS window_start FROM b
      UNION ALL SELECT event_type, s - INTERVAL 5 MINUTE FROM b)
SELECT event_type, window_start, window_start + INTERVAL 10 MINUTE AS window_end, COUNT(*) AS count
FROM w GROUP BY event_type, window_start"""


@register("window_counts", WINDOW_ORACLE_SQL)
def window_counts(spark, sf_dir):
    from navedge.operators.window import sliding_counts
    from navedge.sources.events import read_events
    return sliding_counts(read_events(spark, sf_dir), "ts", ["event_type"])


@register("window_panes", WINDOW_ORACLE_SQL)
def window_panes(spark, sf_dir):
    """The sliding counts from panes: each event is counted once, windows are runs of panes."""
    from navedge.operators.window import sliding_counts_by_panes
    from navedge.sources.events import read_events
    return sliding_counts_by_panes(read_events(spark, sf_dir), "ts", ["event_type"])


# Keyed replace ---------------------------------------------------------------
def _load_in_two(spark, sf_dir):
    """An incremental load: the edge table of the first half of the period, and recomputed totals of every
    edge touched in the second half."""
    from pyspark.sql import functions as F
    from navedge.sources.events import read_events
    rows = load_clicks(spark, sf_dir)
    # the period's bounds: two scalars from the ``ts`` column alone
    lo, hi = read_events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    early = F.col("ts") < F.lit(lo + (hi - lo) / 2).cast("timestamp_ntz")
    # Both tables from one sum per edge.
    sums = rows.groupBy(*S.KEY_COLUMNS).agg(
        F.sum(F.when(early, F.col(S.N))).cast("bigint").alias("before"), F.count_if(early).alias("early"),
        F.sum(S.N).cast("bigint").alias(S.N), F.count_if(~early).alias("late"))
    target = sums.where("early > 0").select(*S.KEY_COLUMNS, F.col("before").alias(S.N))
    return target, sums.where("late > 0").select(*S.EDGE_COLUMNS)


@register("replace_into", _EDGES_SQL)
def replace_into(spark, sf_dir):
    """The batch of an incremental load replaced into the table by key; the result must equal a full rebuild."""
    from navedge.operators.keyed import replace_into as ri
    target, batch = _load_in_two(spark, sf_dir)
    return ri(target, batch, S.KEY_COLUMNS)


@register("replace_bucketed", _EDGES_SQL)
def replace_bucketed(spark, sf_dir):
    """The same load into a stored table: the second batch rewrites the buckets it touches, and the read folds nothing."""
    from navedge.session import scratch_path
    from navedge.sinks.table import read_table, replace_batch
    path = scratch_path(spark, "edge-table")
    for batch_id, batch in enumerate(_load_in_two(spark, sf_dir)):
        replace_batch(batch, path, batch_id, S.KEY_COLUMNS)
    return read_table(spark, path)


# Streaming -------------------------------------------------------------------
# Messages derived from the tables are staged as text files and read back as
# a file stream, about a quarter of the files per trigger, so every query runs
# several micro-batches whatever the file count.
STREAM_BATCHES = 4


def _stream_files(spark):
    """At least one staged file per intended micro-batch."""
    from navedge.session import default_parallelism
    return max(STREAM_BATCHES, default_parallelism(spark))


def _message_stream(spark, sf_dir, fmt="tab"):
    from navedge.sources.messages import files_per_trigger, stage_messages, text_stream
    path = stage_messages(load_clicks(spark, sf_dir), fmt, files=_stream_files(spark))
    return text_stream(spark, path, files_per_trigger(spark, path, STREAM_BATCHES))


def _parsed_stream(spark, sf_dir, fmt="tab"):
    from navedge.streaming.engine import parse_messages
    return parse_messages(_message_stream(spark, sf_dir, fmt), fmt, escaped=True)


def _stream_answer(spark, sf_dir, name, question, fmt="json"):
    """A question run directly as a complete-mode sorted streaming aggregate: its filter sits below the
    state, and the state's key is the answer's column."""
    from navedge.streaming.engine import await_done, latest_answer, run_answers
    q, out = run_answers(question(_parsed_stream(spark, sf_dir, fmt)), {name: lambda batch: batch})
    await_done(q)
    return latest_answer(spark, out, name)


def _stream_edges_of(spark, sf_dir, fmt="tab", only=None):
    """Current edge totals through the change log: each batch writes the edges it changed."""
    from navedge.streaming.engine import await_done, current_edges, edge_totals, run_change_log
    rows = _parsed_stream(spark, sf_dir, fmt)
    q, log = run_change_log(edge_totals(rows if only is None else rows.where(only)))
    await_done(q)
    return current_edges(spark, log)


@register("stream_edges", _CLICK_ROWS_SQL)
def stream_edges(spark, sf_dir):
    from navedge.streaming.engine import await_done, run_append
    q, path = run_append(_parsed_stream(spark, sf_dir, "tab"))
    await_done(q)
    return spark.read.parquet(path)


@register("stream_top_articles", ORACLE["q1_top_articles"])
def stream_top_articles(spark, sf_dir):
    return _stream_answer(spark, sf_dir, "q1", Q.top_articles, "tab")


@register("stream_top_referers", ORACLE["q2_top_referers"])
def stream_top_referers(spark, sf_dir):
    return _stream_answer(spark, sf_dir, "q2", Q.top_referers)


@register("stream_top_from_referer", ORACLE["q3_top_from_referer"])
def stream_top_from_referer(spark, sf_dir):
    return _stream_answer(spark, sf_dir, "q3", Q.top_from_referer)


@register("stream_missing_pages", ORACLE["q4_missing_pages"])
def stream_missing_pages(spark, sf_dir):
    return _stream_answer(spark, sf_dir, "q4", Q.missing_pages)


@register("stream_inflow_outflow", ORACLE["q5_inflow_outflow"])
def stream_inflow_outflow(spark, sf_dir):
    """A whole-table answer through the large-state route: the stream writes only
    the edges each batch changed, and the answer is computed on read from the
    latest row of every edge."""
    return Q.inflow_outflow(_stream_edges_of(spark, sf_dir))


@register("stream_flow_one_pass", ORACLE["q5_inflow_outflow"])
def stream_flow_one_pass(spark, sf_dir):
    """Question 5 as one stateful operator: its state holds a row per title, not per edge."""
    from navedge.operators import flow
    from navedge.operators.aggregate import sorted_desc
    from navedge.sinks.versioned import read_latest_per_key
    from navedge.streaming.engine import await_done, run_change_log
    q, log = run_change_log(flow.flow_totals(_parsed_stream(spark, sf_dir, "json")))
    await_done(q)
    return sorted_desc(flow.flow_of_totals(read_latest_per_key(spark, log, [flow.ARTICLE])), flow.IN_COUNT, ["Article", "out_count", "ratio"])


@register("stream_state_answers", ORACLE["q5_inflow_outflow"])
def stream_state_answers(spark, sf_dir):
    """A stream that writes nothing; question 5 is answered from the edge state in its checkpoint."""
    from navedge.streaming.engine import await_done, edge_totals, run_state_only, state_edges
    q, checkpoint = run_state_only(edge_totals(_parsed_stream(spark, sf_dir, "tab")))
    await_done(q)
    return Q.inflow_outflow(state_edges(spark, checkpoint))


@register("stream_handover", ORACLE["q5_inflow_outflow"])
def stream_handover(spark, sf_dir):
    """A stream is stopped half way and continued by another one with four times the state partitions."""
    from pyspark.sql import functions as F
    from navedge.session import default_parallelism, scratch_path
    from navedge.sources.messages import stage_messages, text_stream
    from navedge.streaming import handover
    from navedge.streaming.engine import await_done, edge_totals, parse_messages, run_state_only, state_edges
    clicks = load_clicks(spark, sf_dir)
    late = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    both, old = scratch_path(spark, "messages-both"), scratch_path(spark, "ckpt-before")
    stage_messages(clicks.where(~late), path=f"{both}/half=0")
    await_done(run_state_only(edge_totals(parse_messages(text_stream(spark, both).select("value"), escaped=True)), old)[0])
    stage_messages(clicks.where(late), path=f"{both}/half=1")
    partitions, new = default_parallelism(spark), scratch_path(spark, "ckpt-after")
    rows = parse_messages(handover.remaining_text(spark, both, old), escaped=True)
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * partitions))  # a query takes its settings when it starts
    try:
        q, _ = run_state_only(edge_totals(handover.continued(rows, old, new)), new)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    await_done(q)
    return Q.inflow_outflow(state_edges(spark, new))


@register("stream_table_replace", _EDGES_SQL)
def stream_table_replace(spark, sf_dir):
    """Changed edges of each micro-batch replaced by key into a stored table."""
    from navedge.sinks.table import read_table
    from navedge.streaming.engine import await_done, edge_totals, run_table
    q, path = run_table(edge_totals(_parsed_stream(spark, sf_dir, "json")), S.KEY_COLUMNS, buckets=16)
    await_done(q)
    return read_table(spark, path)


_TOUCHES_ARTICLE = f"curr LIKE '{S.DEFAULT_ARTICLE_PATTERN}' OR prev LIKE '{S.DEFAULT_ARTICLE_PATTERN}'"


def _article_edges(edges):
    from pyspark.sql import functions as F
    a = Q.into_article(edges).select(F.lit("q7").alias("question"), *S.EDGE_COLUMNS)
    b = Q.out_of_article(edges).select(F.lit("q8").alias("question"), *S.EDGE_COLUMNS)
    return a.unionByName(b)


@register("stream_article_edges", with_fixture(
    f", t2 AS ({_INTO}), t1 AS ({_OUT}) SELECT 'q7' AS question, prev, curr, type, n FROM t2 "
    "UNION ALL SELECT 'q8' AS question, prev, curr, type, n FROM t1"))
def stream_article_edges(spark, sf_dir):
    return _article_edges(_stream_edges_of(spark, sf_dir, "json", _TOUCHES_ARTICLE))


@register("stream_union", ORACLE["q9_union"])
def stream_union(spark, sf_dir):
    """Question 9 on a stream."""
    return Q.both_lists(_stream_edges_of(spark, sf_dir, "json", _TOUCHES_ARTICLE))


@register("stream_update_replace", _EDGES_SQL)
def stream_update_replace(spark, sf_dir):
    return _stream_edges_of(spark, sf_dir, "json")


def _event_stream(spark, sf_dir):
    from navedge.session import scratch_path
    from navedge.sources.events import read_events
    from navedge.sources.messages import files_per_trigger
    staged = scratch_path(spark, "events-stream")
    ev = read_events(spark, sf_dir).select("ts", "event_type")
    # round-robin files, each sorted by time; with no watermark here the order
    # in which files are read does not matter
    ev.repartition(_stream_files(spark)).sortWithinPartitions("ts").write.parquet(staged)
    per = files_per_trigger(spark, staged, STREAM_BATCHES)
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", str(per)).parquet(staged)


def _plain_times(windows):
    from pyspark.sql import functions as F
    return windows.select("event_type", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "count")


@register("stream_window_counts", WINDOW_ORACLE_SQL)
def stream_window_counts(spark, sf_dir):
    from navedge.sinks.versioned import read_latest_per_key
    from navedge.streaming.engine import await_done
    from navedge.streaming.windows import run_window_counts
    q, log = run_window_counts(_event_stream(spark, sf_dir), "ts", ["event_type"])
    await_done(q)
    return _plain_times(read_latest_per_key(spark, log, ["event_type", "window_start", "window_end"]))


@register("stream_window_panes", WINDOW_ORACLE_SQL)
def stream_window_panes(spark, sf_dir):
    """Panes as the only state of the stream; windows are assembled on read."""
    from navedge.streaming.engine import await_done
    from navedge.streaming.windows import current_windows, run_pane_counts
    q, log = run_pane_counts(_event_stream(spark, sf_dir), "ts", ["event_type"])
    await_done(q)
    return _plain_times(current_windows(spark, log, ["event_type"]))


@register("stream_fanout", _CLICK_ROWS_SQL)
def stream_fanout(spark, sf_dir):
    from navedge.sources.files import read_csv
    from navedge.streaming.engine import await_done, run_fanout
    q, csv_path, _ = run_fanout(_parsed_stream(spark, sf_dir, "tab"))
    await_done(q)
    return read_csv(spark, csv_path).select(*S.EDGE_COLUMNS)
