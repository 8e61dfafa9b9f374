"""Every registered query against its DuckDB oracle (the driver's gate)."""

import datetime as dt
import math
import os

import duckdb
import pytest

from conftest import SF_ORACLE, SF_SMALL

import __spark_entry__ as E
from navedge.plans.catalog import ORACLE, QUERIES

TABLES = ["events"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Article", "in_count", "out_count", "ratio"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    expect = _rows([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert _rows(df.collect()) == expect


def test_oracle_dir_exists():
    assert os.path.exists(f"{SF_ORACLE}/events.parquet")


# Messy tables: missing page numbers give null titles, so null keys run through every query and wire form.
@pytest.fixture(scope="module")
def messy(spark, tmp_path_factory):
    from pyspark.sql import functions as F
    d = str(tmp_path_factory.mktemp("messy"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.withColumn("props", F.when(F.col("event_id") % 7 == 0, "{}").otherwise(F.col("props"))).write.parquet(f"{d}/events.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{d}/events.parquet/*.parquet')")
    return d, c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_with_null_titles(spark, messy, name):
    d, c = messy
    df, rel = QUERIES[name](spark, d), c.sql(ORACLE[name])
    idx = [rel.columns.index(x) for x in df.columns]
    assert _rows(df.collect()) == _rows([tuple(r[i] for i in idx) for r in rel.fetchall()])


def test_joined_forms_are_not_vacuous(spark):
    assert QUERIES["q9_same_referer"](spark, SF_ORACLE).count() > 0
    assert QUERIES["q9_paths"](spark, SF_ORACLE).count() > 0
