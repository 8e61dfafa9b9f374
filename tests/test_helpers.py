"""Smaller pieces: log compaction, sizing, corrupt-record capture, scratch paths."""

import os

from conftest import rows
from navedge import schema as S
from navedge.session import checkpoint_root, scale_conf, scratch_path
from navedge.sinks.versioned import committed, compact_log, read_latest_per_key, read_latest_snapshot, write_version
from navedge.sources.files import read_tsv, read_tsv_inferred


def test_compact_log_equals_latest(spark, tmpdir_path):
    log = os.path.join(tmpdir_path, "log")
    mk = lambda data: spark.createDataFrame(data, S.EDGE_SCHEMA)
    write_version(mk([("a", "b", "l", 1), ("c", "d", "l", 1)]), log, 0)
    write_version(mk([("a", "b", "l", 5)]), log, 1)
    assert compact_log(spark, log, S.KEY_COLUMNS) == 1
    write_version(mk([("c", "d", "l", 9)]), log, 2)  # the stream goes on
    got = read_latest_per_key(spark, log, S.KEY_COLUMNS).select(*S.EDGE_COLUMNS)
    assert rows(got) == [("a", "b", "l", 5), ("c", "d", "l", 9)]
    assert compact_log(spark, log, S.KEY_COLUMNS) == 2
    assert rows(read_latest_per_key(spark, log, S.KEY_COLUMNS).select(*S.EDGE_COLUMNS)) == rows(got)


def test_newest_answer_may_be_empty_and_unfinished_batches_stay_hidden(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "snap")
    mk = lambda data: spark.createDataFrame(data, S.EDGE_SCHEMA)
    write_version(mk([("a", "b", "l", 1)]), path, 0)
    write_version(mk([]), path, 1)
    assert read_latest_snapshot(spark, path).count() == 0
    write_version(mk([("x", "y", "l", 7)]), path, 2, commit=False)
    assert committed(spark, path) == [0, 1]
    assert read_latest_snapshot(spark, path).count() == 0
    assert rows(read_latest_per_key(spark, path, S.KEY_COLUMNS).select(*S.EDGE_COLUMNS)) == [("a", "b", "l", 1)]


def test_scale_conf():
    c = scale_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert c["spark.sql.files.maxPartitionBytes"] == str(512 << 20)
    assert int(scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_corrupt_record_column(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "e.tsv"), "w") as f:
        f.write("a\tb\tlink\t3\na\tb\tlink\tzz\n")
    df = read_tsv(spark, tmpdir_path, corrupt_column="_corrupt")
    got = {(r.n, r._corrupt) for r in df.collect()}
    assert got == {(3, None), (None, "a\tb\tlink\tzz")}


def test_inferred_scan(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "e.tsv"), "w") as f:
        f.write('"a\tb\tlink\t3\nc\td"\tlink\t4\n')
    df = read_tsv_inferred(spark, tmpdir_path)
    assert [t for _, t in df.dtypes] == ["string", "string", "string", "bigint"]
    assert sorted(r[0] for r in df.collect()) == ['"a', "c"]


def test_scratch_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    p = scratch_path(spark, "x")
    assert p.startswith(root + "/navedge/x-")
    assert scratch_path(spark, "x") != p


def test_corrupt_column_leaves_shared_schema_alone(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "e.tsv"), "w") as f:
        f.write("a\tb\tlink\t3\n")
    read_tsv(spark, tmpdir_path, corrupt_column="_bad")
    assert S.EDGE_SCHEMA.fieldNames() == S.EDGE_COLUMNS
