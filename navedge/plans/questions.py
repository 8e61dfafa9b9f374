"""The nine clickstream questions, as functions of an edge table.

Every function takes a DataFrame ``(prev, curr, type, n)`` (batch or, where
Spark allows it, streaming) and returns a DataFrame; constants are
parameters whose defaults are the published ones. Ties in every ranking are
broken by the remaining output columns, ascending, nulls last, so a limit
always returns the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navedge import schema as S
from navedge.operators.aggregate import sorted_desc, sum_by, top_k
from navedge.operators.flow import flow_join, flow_one_pass


def _top_sum(edges: DataFrame, key: str, names: tuple[str, str], k: int) -> DataFrame:
    label, total = names
    return top_k(sum_by(edges, key, label, "n", total), total, k, [label])


# Q1 --------------------------------------------------------------------------
def top_articles(edges: DataFrame, k: int = S.DEFAULT_TOP_ARTICLES_K) -> DataFrame:
    """Most requested articles: ``Current_title, Top_Articles``."""
    return _top_sum(edges, "curr", S.Q1_COLUMNS, k)


# Q2 --------------------------------------------------------------------------
def top_referers(edges: DataFrame, k: int = S.DEFAULT_TOP_REFERERS_K) -> DataFrame:
    """Top referrers: ``Referers, Number_of_times_refered``."""
    return _top_sum(edges, "prev", S.Q2_COLUMNS, k)


# Q3 --------------------------------------------------------------------------
def top_from_referer(edges: DataFrame, referer: str = S.DEFAULT_REFERER,
                     k: int = S.DEFAULT_FROM_REFERER_K) -> DataFrame:
    """Top articles reached from one referrer (pushed down to the scan)."""
    return _top_sum(edges.where(F.col("prev") == referer), "curr", S.Q3_COLUMNS, k)


# Q4 --------------------------------------------------------------------------
def missing_pages(edges: DataFrame, link_type: str = S.DEFAULT_MISSING_TYPE,
                  k: int = S.DEFAULT_MISSING_PAGES_K) -> DataFrame:
    """Most requested missing pages (edges of kind ``redlink``)."""
    return _top_sum(edges.where(F.col("type") == link_type), "curr", S.Q4_COLUMNS, k)


# A1 / A2 / A4 ----------------------------------------------------------------
def page_views(edges: DataFrame) -> DataFrame:
    """``Article, in_count``: hits summed per target page."""
    return sum_by(edges, "curr", "Article", "n", "in_count")


def link_clicks(edges: DataFrame) -> DataFrame:
    """``link_clicked, out_count``: hits summed per referrer."""
    return sum_by(edges, "prev", "link_clicked", "n", "out_count")


def curr_totals(edges: DataFrame) -> DataFrame:
    """Hits per target page, sorted descending: ``curr, total``."""
    return sorted_desc(sum_by(edges, "curr", "curr", "n", "total"), "total", ["curr"])


# Q5 / Q6 ---------------------------------------------------------------------
def inflow_outflow(edges: DataFrame) -> DataFrame:
    """``Article, in_count, out_count, ratio`` sorted by ``in_count``."""
    return sorted_desc(flow_one_pass(edges), "in_count", ["Article", "out_count", "ratio"])


def article_flow(edges: DataFrame, article: str = S.DEFAULT_ARTICLE) -> DataFrame:
    """The question-5 row of one article (exact title)."""
    return flow_join(edges, article)


# Q7 / Q8 ---------------------------------------------------------------------
def into_article(edges: DataFrame, pattern: str = S.DEFAULT_ARTICLE_PATTERN,
                 k: int = S.DEFAULT_ARTICLE_EDGES_K) -> DataFrame:
    """Top edges whose target matches the LIKE ``pattern`` (``_`` is a wildcard)."""
    sel = edges.where(F.col("curr").like(pattern)).select(*S.EDGE_COLUMNS)
    return top_k(sel, "n", k, S.KEY_COLUMNS)


def out_of_article(edges: DataFrame, pattern: str = S.DEFAULT_ARTICLE_PATTERN,
                   k: int = S.DEFAULT_ARTICLE_EDGES_K) -> DataFrame:
    """Top edges whose referrer matches the LIKE ``pattern``."""
    sel = edges.where(F.col("prev").like(pattern)).select(*S.EDGE_COLUMNS)
    return top_k(sel, "n", k, S.KEY_COLUMNS)


# Q9 --------------------------------------------------------------------------
def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a UNION b``: rows of either, duplicates removed."""
    return a.unionByName(b).distinct()


def both_lists(edges: DataFrame, pattern: str = S.DEFAULT_ARTICLE_PATTERN,
               k: int = S.DEFAULT_ARTICLE_EDGES_K) -> DataFrame:
    """Edges out of and into the article, as one distinct list."""
    return union_distinct(out_of_article(edges, pattern, k), into_article(edges, pattern, k))


def _ranked(top: DataFrame, prefix: str) -> DataFrame:
    """Rank 1..k of a top-k list, in the list's own order.

    The window has no partition key on purpose: its input is a top-k result,
    which Spark already holds as one partition of at most k rows.
    """
    from pyspark.sql import Window
    order = Window.orderBy(F.col("n").desc_nulls_last(),
                           *[F.col(c).asc_nulls_last() for c in S.KEY_COLUMNS])
    return top.select(F.row_number().over(order).cast("bigint").alias("rank"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in S.EDGE_COLUMNS])


def both_lists_side_by_side(edges: DataFrame, pattern: str = S.DEFAULT_ARTICLE_PATTERN,
                            k: int = S.DEFAULT_ARTICLE_EDGES_K) -> DataFrame:
    """The in-list and the out-list as one table, row i holding the i-th edge of
    each (a full outer join on rank keeps the longer list whole).

    This is question 9's "both lists together" without a cross product: one
    row per rank, at most k rows.
    """
    i, o = _ranked(into_article(edges, pattern, k), "in_"), _ranked(out_of_article(edges, pattern, k), "out_")
    return i.join(o, on="rank", how="full_outer")


def _gathered(top: DataFrame, key: str, alias: str, name: str) -> DataFrame:
    """One row per ``key`` with its edges of a top-k list as an array, strongest first.

    Both list columns of an edge stay, so an array element is a whole edge.
    """
    order = []
    for c in ("n", *S.KEY_COLUMNS):
        order += [F.col(c).isNull().alias(f"{c}_null"), (-F.col(c) if c == "n" else F.col(c)).alias(f"{c}_key")]
    edge = F.struct(*order, F.struct(*S.EDGE_COLUMNS).alias("edge"))
    return top.groupBy(F.col(key).alias(alias)).agg(
        F.transform(F.sort_array(F.collect_list(edge)), lambda x: x["edge"]).alias(name))


def two_step_paths(edges: DataFrame, pattern: str = S.DEFAULT_ARTICLE_PATTERN,
                   k: int = S.DEFAULT_ARTICLE_EDGES_K) -> DataFrame:
    """Paths through an article: ``article, in_edges, out_edges``.

    One row per article that ends an edge of the in-list and starts one of the
    out-list. Every in-edge of a row continues with every out-edge, so the two
    arrays say all paths in at most 2k items; pairs are not written out.
    """
    into = _gathered(into_article(edges, pattern, k), "curr", "article", "in_edges")
    out = _gathered(out_of_article(edges, pattern, k), "prev", "article", "out_edges")
    return into.join(out, on="article", how="inner")


def same_referer(edges: DataFrame, pattern: str = S.DEFAULT_ARTICLE_PATTERN,
                 k: int = S.DEFAULT_ARTICLE_EDGES_K) -> DataFrame:
    """Referrers that both lists share: ``prev, in_edges, out_edges``, one row each."""
    into = _gathered(into_article(edges, pattern, k), "prev", "prev", "in_edges")
    out = _gathered(out_of_article(edges, pattern, k), "prev", "prev", "out_edges")
    return into.join(out, on="prev", how="inner")


#: Slices of a referrer's edges that rank apart before their lists are merged.
LIST_SALTS = 64


def shared_referers(edges: DataFrame, into: str = "%", out: str = "%", k: int = S.DEFAULT_ARTICLE_EDGES_K,
                    salts: int = LIST_SALTS) -> DataFrame:
    """Referrers with edges in both lists, taken without a limit: ``prev, in_rows, in_hits, out_rows, out_hits, in_edges, out_edges``.

    The in-list is every edge whose target matches ``into``, the out-list
    every edge whose referrer matches ``out``. Counts and sums are of all their
    edges; the arrays hold the k strongest. Lists are merged in two levels, the
    k strongest of each slice of a referrer's edges and then of these, so that
    a referrer with a third of all edges is never gathered in one task.
    """
    from pyspark.sql import Window
    sides = F.array(F.when(F.col("curr").like(into), F.lit("in")), F.when(F.col("prev").like(out), F.lit("out")))
    rows = edges.where(F.col("prev").isNotNull()).select(*S.EDGE_COLUMNS, F.explode(sides).alias("side")).where("side IS NOT NULL")
    is_in = F.col("side") == "in"
    totals = rows.groupBy("prev").agg(
        F.count_if(is_in).alias("in_rows"), F.sum(F.when(is_in, F.col("n"))).cast("bigint").alias("in_hits"),
        F.count_if(~is_in).alias("out_rows"), F.sum(F.when(~is_in, F.col("n"))).cast("bigint").alias("out_hits")
    ).where("in_rows > 0 AND out_rows > 0")
    strongest = [F.col("n").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in S.KEY_COLUMNS]]
    # The whole edge is hashed: repeated edges share a slice, where k of them are enough.
    salted = rows.withColumn("_nv_salt", F.pmod(F.xxhash64("curr", "type", "n"), F.lit(int(salts))))
    first = salted.withColumn("_nv_rank", F.row_number().over(Window.partitionBy("side", "prev", "_nv_salt").orderBy(*strongest)))
    first = first.where(F.col("_nv_rank") <= int(k)).drop("_nv_rank")
    best = first.withColumn("_nv_rank", F.row_number().over(Window.partitionBy("side", "prev").orderBy(*strongest))).where(F.col("_nv_rank") <= int(k))
    at = F.struct(F.col("_nv_rank"), F.struct(*S.EDGE_COLUMNS).alias("edge"))
    listed = lambda side: F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == side, at))), lambda x: x["edge"])
    lists = best.groupBy("prev").agg(listed("in").alias("in_edges"), listed("out").alias("out_edges"))  # 2k edges at most
    return totals.join(lists, "prev")


# Q1-Q4 in one grouping -------------------------------------------------------
def questions_one_pass(edges: DataFrame, referer: str = S.DEFAULT_REFERER, link_type: str = S.DEFAULT_MISSING_TYPE,
                       k: int | None = None) -> DataFrame:
    """``question, label, total`` of questions 1-4 from one scan and one grouping of the edges.

    Each edge becomes a row for every question it counts in; sums are taken
    by question and label. The ranks then move at most k rows a task and question.
    """
    from pyspark.sql import Window
    most = {"q1": k or S.DEFAULT_TOP_ARTICLES_K, "q2": k or S.DEFAULT_TOP_REFERERS_K, "q3": k or S.DEFAULT_FROM_REFERER_K,
            "q4": k or S.DEFAULT_MISSING_PAGES_K}
    row = lambda q, label: F.struct(F.lit(q).alias("question"), F.col(label).alias("label"))
    asked = F.array(row("q1", "curr"), row("q2", "prev"), F.when(F.col("prev") == referer, row("q3", "curr")),
                    F.when(F.col("type") == link_type, row("q4", "curr")))
    rows = edges.select("n", F.explode(asked).alias("a")).where(F.col("a").isNotNull()).select("a.question", "a.label", "n")
    sums = rows.groupBy("question", "label").agg(F.sum("n").cast("bigint").alias("total"))
    order = Window.partitionBy("question").orderBy(F.col("total").desc_nulls_last(), F.col("label").asc_nulls_last())
    # The literal bound lets Spark cut every task's rows before the exchange.
    ranked = sums.withColumn("_nv_rank", F.row_number().over(order)).where(F.col("_nv_rank") <= max(most.values()))
    limit = F.element_at(F.create_map(*[F.lit(x) for q, m in most.items() for x in (q, int(m))]), F.col("question"))
    return ranked.where(F.col("_nv_rank") <= limit).select("question", "label", "total")


def edge_text(array):
    """An array of edges as text: ``prev>curr:type:n`` joined by ``; `` (null prints as ``null``)."""
    part = lambda x, c: F.coalesce(x[c].cast("string"), F.lit("null"))
    return F.array_join(F.transform(array, lambda x: F.concat(
        part(x, "prev"), F.lit(">"), part(x, "curr"), F.lit(":"), part(x, "type"), F.lit(":"), part(x, "n"))), "; ")


def edges_where(edges: DataFrame, predicate: str) -> DataFrame:
    """Edges passing a SQL predicate given as text (``.where(text)``)."""
    return edges.where(predicate)


def all_questions(referer: str = S.DEFAULT_REFERER, link_type: str = S.DEFAULT_MISSING_TYPE,
                  article: str = S.DEFAULT_ARTICLE, pattern: str = S.DEFAULT_ARTICLE_PATTERN,
                  k: int | None = None, joined: bool = False) -> dict[str, callable]:
    """Every question as ``name -> (edges -> DataFrame)``, with its parameters bound; ``k`` replaces each default.

    ``joined`` adds the joined forms of question 9; their lists of edges are text, which any sink can hold.
    """
    size = {} if k is None else {"k": int(k)}
    as_text = lambda df: df.withColumns({c: edge_text(c) for c in ("in_edges", "out_edges")})
    more = {
        "both_lists_side_by_side": lambda e: both_lists_side_by_side(e, pattern, **size),
        "two_step_paths": lambda e: as_text(two_step_paths(e, pattern, **size)),
        "same_referer": lambda e: as_text(same_referer(e, pattern, **size)),
        "shared_referers": lambda e: as_text(shared_referers(e, **size)),
    } if joined else {}
    return {
        **more,
        "top_articles": lambda e: top_articles(e, **size),
        "top_referers": lambda e: top_referers(e, **size),
        "top_from_referer": lambda e: top_from_referer(e, referer, **size),
        "missing_pages": lambda e: missing_pages(e, link_type, **size),
        "inflow_outflow": inflow_outflow,
        "article_flow": lambda e: article_flow(e, article),
        "into_article": lambda e: into_article(e, pattern, **size),
        "out_of_article": lambda e: out_of_article(e, pattern, **size),
        "both_lists": lambda e: both_lists(e, pattern, **size),
    }
