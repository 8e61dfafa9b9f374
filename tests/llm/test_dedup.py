import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from navedge.llm import exact_dedup as X

from .data import SF, collected, docs


def brute(rows):
    """Rows (doc_id, text) -> (doc_id, keep_id, group_size, text_sha256)."""
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: m[:3])[3]
        out += [(m[3], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


ROWS = ([(1, "a b"), (2, "ab "), (3, "a  b\n"), (4, None), (5, ""), (6, " \t"), (7, "c"), (7, "c"), (None, "c"), (8, "é x"), (9, "éx"),
         (10, "long " * 20000), (11, "long" * 20000), (None, None)] + [(100 + i, "same text") for i in range(600)])


def test_matches_brute_force_with_nulls_ties_and_repeats(spark):
    out = X.assign_groups(docs(spark, ROWS).repartition(5))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out.collect()), key=repr) == brute(ROWS)
    kept = out.groupBy("text_sha256").agg(F.count_if("kept").alias("n")).collect()
    assert all(r.n == 1 for r in kept)


def test_weak_digest_is_checked_against_full_text(spark):
    weak = lambda norm: F.unhex(F.substring(F.sha2(norm.cast("binary"), 256), 1, 2))
    rows = [(i, f"text {i % 90}") for i in range(400)]
    out = X.assign_groups(docs(spark, rows), digest=weak, broadcast_rows=3)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in out.collect()) == sorted(x[:3] for x in brute(rows))


def test_keep_first_keeps_columns_and_one_row_a_group(spark):
    df = docs(spark, ROWS)
    out = X.keep_first(df)
    assert out.columns == df.columns
    assert out.count() == len({b[3] for b in brute(ROWS)})


def test_empty(spark):
    assert X.assign_groups(docs(spark, [])).count() == 0 and X.keep_first(docs(spark, [])).count() == 0


def test_later_files_join_the_same_state(spark, tmp_path):
    rows = X.arrivals(X.located(docs(spark, [(1, "a"), (2, "b")])))
    path, state, log = (str(tmp_path / n) for n in ("in", "state", "log"))
    rows.write.parquet(path)
    assert {r.n for r in X.run_state(spark, path, rows.schema, state, log).collect()} == {1}
    X.arrivals(X.located(docs(spark, [(3, "a a"), (4, "a")]))).write.mode("append").parquet(path)
    got = {r.best.inv_id: r.n for r in X.run_state(spark, path, rows.schema, state, log).collect()}
    assert got == {~1: 2, ~2: 1, ~3: 1}


def test_query_equals_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS FROM '{SF}/documents.parquet'")
    got = X.op7_exact_dedup(spark, SF).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert collected(got) == sorted(duckdb.sql(X.SQL).fetchall(), key=repr)


def test_columns_named_like_the_locator_stay(spark):
    from navedge.llm import exact_dedup, simhash
    d = spark.createDataFrame([(1, "a b c d", 7, "x"), (2, "ab cd", 8, "y"), (3, "other words here", 9, "z")], "doc_id long, text string, _nv_row long, _nv_file string")
    for kept, want in ((exact_dedup.keep_first(d), [(1, 7, "x"), (3, 9, "z")]), (simhash.keep_one(d, 3, 3), [(1, 7, "x"), (2, 8, "y"), (3, 9, "z")])):
        assert kept.columns == d.columns
        assert sorted((r.doc_id, r._nv_row, r._nv_file) for r in kept.collect()) == want
