"""Click edges derived from the driver's ``events`` table.

The test data has no clickstream dump, so one is derived: each event is a
page view whose title comes from ``props.k``; the referrer is the user's
previous page, or a synthetic ``other-*`` source for searches and sign-ups.
``clicks`` has one row per event (the message stream); ``clickstream`` sums
them into the edge table ``(prev, curr, type, n)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navedge.operators.sequence import skew_safe_lag

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "props"]

# Fixed values of the fixture: page titles by k % 20, referrer and link kind
# by event type. Titles 0 and 1 differ by one character that LIKE's ``_``
# wildcard matches, so equality and LIKE select different rows.
TITLE_FOR_K0 = "Deaths_in_2015"
TITLE_FOR_K1 = "Deaths-in-2015"
TITLE_PREFIX = "Page_"
REFERER_BY_EVENT = {"view": "other-search", "signup": "other-twitter"}
NO_REFERER = "other-empty"
TYPE_BY_EVENT = {"error": "redlink", "click": "link", "purchase": "link"}
DEFAULT_TYPE = "external"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _page_title(k20: Column) -> Column:
    """Title of a page from ``k % 20`` (null when ``k`` is missing)."""
    return (F.when(k20 == 0, F.lit(TITLE_FOR_K0))
            .when(k20 == 1, F.lit(TITLE_FOR_K1))
            .otherwise(F.concat(F.lit(TITLE_PREFIX), k20.cast("string"))))


def _k20(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("int") % 20


def _case(col: Column, mapping: dict[str, str], default: Column) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out.otherwise(default)


def clicks(events: DataFrame, num_slices: int | None = None) -> DataFrame:
    """One click message per event: ``event_id, ts, prev, curr, type, n``.

    The referrer is the title of the user's previous event. Titles are a
    function of ``k % 20`` from ``props``; ``k`` is parsed once per row, after
    the lag's range exchange (JSON parsing is the costliest step here), and
    the lag carries that integer rather than the JSON text.
    """
    a = events.select("event_id", "ts", "user_id", "event_type", "props")
    ks = skew_safe_lag(a, "user_id", ["ts", "event_id"], _k20(F.col("props")), "_pk",
                       num_slices, value_name="_k")
    et = F.col("event_type")
    prev_page = F.coalesce(_page_title(F.col("_pk")), F.lit(NO_REFERER))
    return ks.select(
        "event_id", "ts",
        _case(et, REFERER_BY_EVENT, prev_page).alias("prev"),
        _page_title(F.col("_k")).alias("curr"),
        _case(et, TYPE_BY_EVENT, F.lit(DEFAULT_TYPE)).alias("type"),
        F.lit(1).cast("bigint").alias("n"))


def clickstream(click_rows: DataFrame) -> DataFrame:
    """Edge table: hits summed per ``(prev, curr, type)``."""
    return (click_rows.groupBy("prev", "curr", "type")
            .agg(F.sum("n").cast("bigint").alias("n")))


def load_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks(read_events(spark, sf_dir))


def load_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream(load_clicks(spark, sf_dir))


# DuckDB text of the same derivation, shared by the oracle queries.
CLICKS_SQL = """
a AS (SELECT event_id, ts, user_id, event_type,
    CASE CAST(json_extract_string(props, '$.k') AS INT) % 20
        WHEN 0 THEN 'Deaths_in_2015' WHEN 1 THEN 'Deaths-in-2015'
        ELSE 'Page_' || CAST(CAST(json_extract_string(props, '$.k') AS INT) % 20 AS VARCHAR) END AS curr
  FROM events),
l AS (SELECT *, LAG(curr) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM a),
clicks AS (SELECT event_id, ts,
    CASE event_type WHEN 'view' THEN 'other-search' WHEN 'signup' THEN 'other-twitter'
        ELSE COALESCE(p, 'other-empty') END AS prev,
    curr,
    CASE event_type WHEN 'error' THEN 'redlink' WHEN 'click' THEN 'link'
        WHEN 'purchase' THEN 'link' ELSE 'external' END AS type,
    CAST(1 AS BIGINT) AS n
  FROM l),
clickstream AS (SELECT prev, curr, type, CAST(SUM(n) AS BIGINT) AS n
  FROM clicks GROUP BY prev, curr, type)
"""


def with_fixture(sql_body: str) -> str:
    """Prefix an oracle query with the clicks/clickstream CTEs."""
    return "WITH " + CLICKS_SQL.strip() + "\n" + sql_body.strip()
