"""Command line: the batch questions over an edge file, or the message stream.

  python -m navedge questions --input edges.tsv --out DIR [--input-format tsv|parquet|changelog|table|state]
                              [--output-format parquet|csv] [--joined] [--jdbc-url URL ...]
  python -m navedge stream <bootstrap-servers> <subscribe-type> <topics> <checkpoint-location>
                           --out DIR [--message-format tab|strict|json] [--trigger "40 seconds"]
                           [--route changelog|complete|table|state|append|fanout|legs|windows|topic|console]
                           [--k N] [--referer ...]
                           [--starting-offsets earliest] [--allow-data-loss] [--max-offsets-per-trigger N]
  python -m navedge stream --source-dir DIR <checkpoint-location> --out DIR ...   (file stream)
  python -m navedge compact --log DIR [--trim]                 (fold the change log of a stream; it may go on)
  python -m navedge vacuum --table DIR [--keep N]              (drop replaced versions of a stored table)
  python -m navedge conf --input-bytes 100T --cores 8000       (spark-submit --conf flags)

The checkpoint location is required for streams: a random one (the original
default) would make a restarted job start over.
"""

from __future__ import annotations

import argparse
import sys

from navedge import schema as S


def _session():
    from navedge.session import get_session
    return get_session()


def _write(df, path: str, fmt: str) -> None:
    if fmt == "csv":
        from navedge.sources.files import write_csv
        write_csv(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def load_edges_for_questions(spark, path: str, fmt: str, sep: str = "\t"):
    """Edge table for the questions. A TSV dump is converted to Parquet once
    (in the shared scratch folder) so that the nine questions read pruned
    columns with pushed filters instead of parsing the text nine times; a
    change log is folded to each edge's latest row; the state of a stream is
    read from its checkpoint."""
    from navedge.session import scratch_path
    from navedge.sources.files import drop_header, read_tsv
    if fmt == "parquet":
        return spark.read.parquet(path)
    staged = scratch_path(spark, "edges-parquet")
    if fmt == "table":
        from navedge.sinks.table import read_table
        return read_table(spark, path)
    if fmt == "state":
        from navedge.streaming.engine import state_edges
        state_edges(spark, path).write.parquet(staged)
    elif fmt == "changelog":
        from navedge.streaming.engine import current_edges
        current_edges(spark, path).write.parquet(staged)
    else:
        drop_header(read_tsv(spark, path, sep=sep)).write.parquet(staged)
    return spark.read.parquet(staged)


def cmd_questions(args) -> int:
    from navedge.plans.questions import all_questions
    spark = _session()
    edges = load_edges_for_questions(spark, args.input, args.input_format, args.sep)
    answers = all_questions(args.referer, args.link_type, args.article, args.pattern, args.k, args.joined)
    for name, fn in answers.items():
        path = f"{args.out.rstrip('/')}/{name}"
        result = fn(edges)
        _write(result, path, args.output_format)
        if args.jdbc_url:
            from navedge.sinks.jdbc import jdbc_options, write_table
            if args.output_format == "parquet":
                result = spark.read.parquet(path)  # the answer as written, not computed again
            write_table(result, jdbc_options(args.jdbc_url, name, args.jdbc_user, args.jdbc_password))
    return 0


def cmd_stream(args) -> int:
    from navedge.sources.messages import kafka_options, kafka_stream, text_stream
    from navedge.streaming import engine as X
    from navedge.streaming import handover
    spark = _session()
    if args.continues and args.route not in EDGE_STATE_ROUTES:
        print(f"--continues is for the routes {', '.join(EDGE_STATE_ROUTES)}", file=sys.stderr)
        return 2
    if args.source_dir:
        raw = (handover.remaining_text(spark, args.source_dir, args.continues, args.max_files_per_trigger, args.read_since) if args.continues
               else text_stream(spark, args.source_dir, args.max_files_per_trigger))
        checkpoint = args.positional[0] if args.positional else None
    else:
        if len(args.positional) < 4:
            print("usage: stream <bootstrap-servers> <subscribe-type> <topics> <checkpoint-location>",
                  file=sys.stderr)
            return 2
        servers, kind, topics, checkpoint = args.positional[:4]
        offsets = handover.starting_offsets(spark, args.continues) if args.continues else args.starting_offsets
        raw = kafka_stream(spark, kafka_options(servers, kind, topics, offsets,
                                                not args.allow_data_loss, args.max_offsets_per_trigger))
    if not checkpoint:
        print("a checkpoint location is required", file=sys.stderr)
        return 2
    if args.route == "topic" and not (args.to_topic or "").rpartition("/")[0]:
        print("--to-topic host:port/name is required", file=sys.stderr)
        return 2
    if args.route not in ("console", "state", "topic") and not args.out:
        print("--out is required", file=sys.stderr)
        return 2
    if args.jdbc_url and args.route not in JDBC_ROUTES:
        print(f"--jdbc-url is for the routes {', '.join(JDBC_ROUTES)}", file=sys.stderr)
        return 2
    fmt, strict = ("tab", True) if args.message_format == "strict" else (args.message_format, False)
    rows = X.parse_messages(raw, fmt, strict=strict, escaped=args.escaped)
    if args.continues:
        rows = handover.continued(rows, args.continues, checkpoint)
    X.await_done(_start_route(args, raw, rows, checkpoint), args.timeout)
    return 0


#: Routes with a relational table as a sink: rows appended, or one table an answer.
JDBC_ROUTES = ("fanout", "legs", "complete")
#: Routes whose state is the edge table.
EDGE_STATE_ROUTES = ("changelog", "complete", "table", "state", "topic")


def _start_route(args, raw, rows, checkpoint):
    from navedge.plans.questions import all_questions
    from navedge.streaming import engine as X
    out = args.out.rstrip("/") if args.out else None
    answers = all_questions(args.referer, args.link_type, args.article, args.pattern, args.k, args.joined)
    if args.route == "changelog":
        return X.run_change_log(X.edge_totals(rows), args.out, checkpoint, args.trigger, "navedge_edges")[0]
    if args.route == "table":
        return X.run_table(X.edge_totals(rows), S.KEY_COLUMNS, args.out, checkpoint, args.trigger, "navedge_table", args.buckets)[0]
    if args.route == "state":
        return X.run_state_only(X.edge_totals(rows), checkpoint, args.trigger, "navedge_state")[0]
    if args.route == "append":
        return X.run_append(rows, args.out, checkpoint, args.trigger, "navedge_append")[0]
    if args.route == "fanout":
        return X.run_fanout(rows, f"{out}/csv", f"{out}/parquet", _jdbc_batch_writer(args), checkpoint, args.trigger)[0]
    if args.route == "legs":
        return X.run_legs(rows, out, answers, _jdbc_batch_writer(args), checkpoint, args.trigger)[0]
    if args.route == "windows":
        from navedge.streaming.windows import run_pane_counts
        return run_pane_counts(_timed(raw, args), args.time_column, [], args.watermark, args.out, checkpoint, args.trigger,
                               width=args.width, slide=args.slide, offset=args.offset)[0]
    if args.route == "topic":
        from navedge.sources.messages import kafka_message_sink
        servers, _, topic = args.to_topic.rpartition("/")
        trigger = None if args.trigger == "availableNow" else args.trigger
        return kafka_message_sink(X.edge_totals(rows), servers, topic, checkpoint, trigger)
    if args.route == "console":
        return X.run_console(rows, trigger=args.trigger, checkpoint=checkpoint)
    return X.run_answers(X.edge_totals(rows), answers, out_root=args.out, checkpoint=checkpoint, trigger=args.trigger,
                         name="navedge_answers", table_write=_jdbc_answer_writer(args))[0]


def _timed(raw, args):
    """Arrival times of messages: a column of the source (``timestamp`` of a topic), or of JSON messages."""
    from pyspark.sql import functions as F
    if args.time_column in raw.columns:
        return raw.select(args.time_column)
    value = F.get_json_object(F.col("value").cast("string"), f"$.{args.time_column}")
    return raw.select(value.try_cast("timestamp").alias(args.time_column)).where(F.col(args.time_column).isNotNull())


def _jdbc_answer_writer(args):
    if not args.jdbc_url:
        return None
    from navedge.sinks.jdbc import foreach_batch_writer, jdbc_options
    return lambda name: foreach_batch_writer(jdbc_options(args.jdbc_url, name, args.jdbc_user, args.jdbc_password), whole_answer=True)


def _jdbc_batch_writer(args):
    if not args.jdbc_url:
        return None
    from navedge.sinks.jdbc import foreach_batch_writer, jdbc_options
    return foreach_batch_writer(jdbc_options(args.jdbc_url, args.jdbc_table, args.jdbc_user, args.jdbc_password))


_UNITS = {"": 1, "K": 1 << 10, "M": 1 << 20, "G": 1 << 30, "T": 1 << 40, "P": 1 << 50}


def parse_bytes(text: str) -> int:
    """``100T``, ``512G``, ``2048`` -> bytes (binary units)."""
    t = text.strip().upper().rstrip("B")
    unit = t[-1] if t and t[-1] in _UNITS else ""
    return int(float(t[: len(t) - len(unit)]) * _UNITS[unit])


def cmd_conf(args) -> int:
    from navedge.session import scale_conf
    for k, v in scale_conf(parse_bytes(args.input_bytes), args.cores).items():
        print(f"--conf {k}={v}")
    return 0


def cmd_compact(args) -> int:
    from navedge.sinks.versioned import compact_log, trim_log
    spark = _session()
    reached = compact_log(spark, args.log, args.keys.split(","))
    removed = trim_log(spark, args.log) if args.trim else 0
    print(f"folded up to batch {reached}, removed {removed} folders")
    return 0


def cmd_vacuum(args) -> int:
    from navedge.sinks.table import vacuum
    print(f"removed {vacuum(_session(), args.table, args.keep)} folders")
    return 0


def _question_arguments(p: argparse.ArgumentParser) -> None:
    p.add_argument("--referer", default=S.DEFAULT_REFERER)
    p.add_argument("--link-type", default=S.DEFAULT_MISSING_TYPE)
    p.add_argument("--article", default=S.DEFAULT_ARTICLE)
    p.add_argument("--pattern", default=S.DEFAULT_ARTICLE_PATTERN)
    p.add_argument("--k", type=int, help="rows of every ranked answer (default: each question's own)")
    p.add_argument("--joined", action="store_true", help="also the joined forms of question 9")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="navedge")
    sub = p.add_subparsers(dest="cmd", required=True)

    q = sub.add_parser("questions", help="answer the nine questions over an edge table")
    q.add_argument("--input", required=True)
    q.add_argument("--input-format", choices=["tsv", "parquet", "changelog", "table", "state"], default="tsv",
                   help="changelog, table: written by those routes of `stream`; state: the checkpoint of `stream --route state`")
    q.add_argument("--sep", default="\t")
    q.add_argument("--out", required=True)
    q.add_argument("--output-format", choices=["parquet", "csv"], default="parquet")
    _question_arguments(q)
    q.set_defaults(fn=cmd_questions)

    s = sub.add_parser("stream", help="answer the questions continuously from messages")
    s.add_argument("positional", nargs="*")
    s.add_argument("--source-dir", help="read message lines from files instead of Kafka")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--message-format", choices=["tab", "strict", "json"], default="tab")
    s.add_argument("--escaped", action="store_true", help="fields carry the marks of `escape_field`")
    s.add_argument("--out", help="folder of the results; not for console")
    s.add_argument("--route", default="changelog",
                   choices=["changelog", "complete", "table", "state", "append", "fanout", "legs", "windows", "topic", "console"],
                   help="changelog: changed edges per batch, answers on read with `questions --input-format changelog`; "
                        "complete: answers per batch; append: parsed rows; fanout: rows to CSV, Parquet and JDBC; "
                        "console: rows printed; table: edges replaced by key into a stored table; state: no output, answers are read "
                        "from the checkpoint; legs: rows and answers of each batch in all sinks, published together; windows: "
                        "message counts per pane of the sliding window; topic: edges as messages")
    s.add_argument("--buckets", type=int, default=64, help="buckets of --route table")
    s.add_argument("--to-topic", help="host:port/topic of --route topic")
    s.add_argument("--time-column", default="timestamp", help="of the source or of JSON messages, for --route windows")
    s.add_argument("--watermark")
    s.add_argument("--width", default=S.DEFAULT_WINDOW[0])
    s.add_argument("--slide", default=S.DEFAULT_WINDOW[1])
    s.add_argument("--offset", default=S.DEFAULT_WINDOW[2])
    s.add_argument("--continues", metavar="CHECKPOINT",
                   help="checkpoint of a stopped query of these routes whose edge state this one takes over, in as many partitions as "
                        "this session shuffles to; --out and the checkpoint must be new")
    s.add_argument("--read-since", help="with --continues: files last changed before this time are known to be read")
    s.add_argument("--starting-offsets", default="earliest")
    s.add_argument("--allow-data-loss", action="store_true", help="go on when offsets were lost")
    s.add_argument("--max-offsets-per-trigger", type=int)
    s.add_argument("--jdbc-table", default="edges")
    _question_arguments(s)
    s.add_argument("--trigger", default=S.DEFAULT_TRIGGER,
                   help='processing-time interval, or "availableNow" to drain and stop')
    s.add_argument("--timeout", type=float, help="seconds to wait before returning")
    s.set_defaults(fn=cmd_stream)

    f = sub.add_parser("compact", help="fold the change log of a stream into a base")
    f.add_argument("--log", required=True)
    f.add_argument("--keys", default=",".join(S.KEY_COLUMNS))
    f.add_argument("--trim", action="store_true", help="delete what the base covers")
    f.set_defaults(fn=cmd_compact)

    v = sub.add_parser("vacuum", help="delete replaced versions of a stored table")
    v.add_argument("--table", required=True)
    v.add_argument("--keep", type=int, default=2, help="batches whose tables stay readable")
    v.set_defaults(fn=cmd_vacuum)

    c = sub.add_parser("conf", help="print --conf flags sized for an input")
    c.add_argument("--input-bytes", required=True, help="e.g. 100T, 512G")
    c.add_argument("--cores", type=int, required=True, help="total executor cores")
    c.set_defaults(fn=cmd_conf)

    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
