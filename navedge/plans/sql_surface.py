"""Questions 1-4 as SQL text over a named view of the edge table.

Users of the original ran such questions as ``spark.sql`` text. One builder
makes the four statements; they group by the select alias, and every value
(filter, number of rows) is a bound parameter, never part of the text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame

from navedge import schema as S


@dataclass(frozen=True)
class TopSum:
    """The ``k`` greatest sums of ``n`` by one column, over edges whose ``where`` column has a value."""

    key: str
    names: tuple[str, str]
    k: int
    where: str | None = None
    value: str | None = None

    def text(self, view: str) -> str:
        label, total = self.names
        return " ".join([
            f"SELECT {self.key} AS {label}, CAST(SUM(n) AS BIGINT) AS {total} FROM {view}",
            f"WHERE {self.where} = :value" if self.where else "",
            f"GROUP BY {label} ORDER BY {total} DESC NULLS LAST, {label} ASC NULLS LAST LIMIT :k"])

    def args(self) -> dict:
        return {"k": self.k, **({"value": self.value} if self.where else {})}


def statements(referer: str = S.DEFAULT_REFERER, link_type: str = S.DEFAULT_MISSING_TYPE,
               k: int | None = None) -> dict[str, TopSum]:
    return {
        "q1": TopSum("curr", S.Q1_COLUMNS, k or S.DEFAULT_TOP_ARTICLES_K),
        "q2": TopSum("prev", S.Q2_COLUMNS, k or S.DEFAULT_TOP_REFERERS_K),
        "q3": TopSum("curr", S.Q3_COLUMNS, k or S.DEFAULT_FROM_REFERER_K, "prev", referer),
        "q4": TopSum("curr", S.Q4_COLUMNS, k or S.DEFAULT_MISSING_PAGES_K, "type", link_type),
    }


def register_view(edges: DataFrame, name: str | None = None) -> str:
    name = name or f"clickQuery_{uuid.uuid4().hex[:8]}"
    edges.createOrReplaceTempView(name)
    return name


def question_sql(edges: DataFrame, question: str, view: str | None = None, **params) -> DataFrame:
    statement = statements(**params)[question]
    return edges.sparkSession.sql(statement.text(view or register_view(edges)), args=statement.args())


def stacked_questions(edges: DataFrame, **params) -> DataFrame:
    """``question, label, total`` for questions 1-4, run as SQL text."""
    view = register_view(edges)
    out = None
    for q in statements(**params):
        df = question_sql(edges, q, view, **params)
        label, total = df.columns
        part = df.selectExpr(f"'{q}' AS question", f"{label} AS label", f"{total} AS total")
        out = part if out is None else out.unionAll(part)
    # the SQL text is analysed already (the view's plan is inlined), so the
    # session catalog need not keep one view per call
    edges.sparkSession.catalog.dropTempView(view)
    return out
