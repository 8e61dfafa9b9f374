"""The click-edge data model and the fixed values the questions use."""

from __future__ import annotations

from pyspark.sql import types as T

PREV, CURR, TYPE, N = "prev", "curr", "type", "n"
EDGE_COLUMNS = [PREV, CURR, TYPE, N]
KEY_COLUMNS = [PREV, CURR, TYPE]
# The message path of the original names the third column ``link``; the file
# path names it ``type``. ``type`` is canonical, ``link`` is accepted on input.

EDGE_SCHEMA = T.StructType([
    T.StructField(PREV, T.StringType(), True),
    T.StructField(CURR, T.StringType(), True),
    T.StructField(TYPE, T.StringType(), True),
    T.StructField(N, T.LongType(), True),
])

# JSON messages carry the link kind under ``link``.
JSON_MESSAGE_SCHEMA = T.StructType([
    T.StructField("prev", T.StringType(), True),
    T.StructField("curr", T.StringType(), True),
    T.StructField("link", T.StringType(), True),
    T.StructField("n", T.LongType(), True),
])

# Defaults of the nine questions, equal to the original's
# constants (top-k sizes, referrer, link kind, article, window spec).
DEFAULT_TOP_ARTICLES_K = 5
DEFAULT_TOP_REFERERS_K = 10
DEFAULT_FROM_REFERER_K = 5
DEFAULT_MISSING_PAGES_K = 10
DEFAULT_ARTICLE_EDGES_K = 10
DEFAULT_REFERER = "other-twitter"
DEFAULT_MISSING_TYPE = "redlink"
DEFAULT_ARTICLE = "Deaths_in_2015"
DEFAULT_ARTICLE_PATTERN = "Deaths_in_2015"
DEFAULT_WINDOW = ("10 minutes", "5 minutes", "2 minutes")
DEFAULT_TRIGGER = "40 seconds"
MARKUP_PATTERN = r"\[\w+\]:"

# Result column names of the nine questions (fixed values, as published).
Q1_COLUMNS = ("Current_title", "Top_Articles")
Q2_COLUMNS = ("Referers", "Number_of_times_refered")
Q3_COLUMNS = ("Top_articles_In_Twitter", "Number_of_times_refered")
Q4_COLUMNS = ("Top_missing_pages", "Number_of_times_refered")
FLOW_COLUMNS = ("Article", "in_count", "out_count", "ratio")
