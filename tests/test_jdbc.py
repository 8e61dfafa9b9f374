"""JDBC writer wiring, checked without a database (none is started here)."""

from navedge.sinks import jdbc


def test_options_and_batch_tables():
    o = jdbc.jdbc_options("jdbc:postgresql://db/clickers", "top_articles", "u", "p",
                          driver="org.postgresql.Driver")
    assert o == {"url": "jdbc:postgresql://db/clickers", "dbtable": "top_articles", "user": "u",
                 "password": "p", "driver": "org.postgresql.Driver"}
    assert jdbc.commit_table(o)["dbtable"] == "top_articles_commits"


def test_answers_overwrite_and_appends_commit(spark, monkeypatch):
    calls, done = [], set()

    def write(df, opts, mode="overwrite", **kw):
        calls.append((opts["dbtable"], mode, df.columns, df.count()))
        if opts["dbtable"].endswith("_commits"):
            done.update(r.batch_id for r in df.collect())

    monkeypatch.setattr(jdbc, "write_table", write)
    monkeypatch.setattr(jdbc, "is_committed", lambda spark, opts, batch_id: batch_id in done)
    opts = jdbc.jdbc_options("jdbc:x", "edges")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "prev string, n long")
    jdbc.foreach_batch_writer(opts, whole_answer=True)(df, 3)
    assert calls == [("edges", "overwrite", ["prev", "n"], 2)]
    calls.clear()
    append = jdbc.foreach_batch_writer(opts)
    append(df, 3)
    assert [c[:2] + c[3:] for c in calls] == [("edges_commits", "append", 0), ("edges", "append", 2), ("edges_commits", "append", 1)]
    assert calls[1][2] == ["prev", "n", "batch_id", "attempt"]
    calls.clear()
    append(df, 3)  # replayed after its commit: nothing is written
    assert [c[0] for c in calls] == ["edges_commits"] and calls[0][3] == 0


def test_half_written_attempts_are_left_out(spark):
    rows = spark.createDataFrame([("a", 0, "x"), ("a", 0, "y"), ("b", 1, "z")], "prev string, batch_id long, attempt string")
    commits = spark.createDataFrame([(0, "y")], jdbc.COMMIT_COLUMNS)
    assert [tuple(r) for r in jdbc.read_appended(rows, commits).collect()] == [("a",)]


def test_partitioned_read_options(monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return "df"

    class Session:
        read = Reader()

    assert jdbc.read_table(Session(), jdbc.jdbc_options("jdbc:x", "edges"), "n", 0, 1000, 16) == "df"
    assert seen["partitionColumn"] == "n" and seen["numPartitions"] == "16" and seen["upperBound"] == "1000"
