"""Command-line jobs, one per analytic job of the original pipeline.

Run with ``spark-submit run_job.py <job> ...`` (from any folder; the package is
sent to the executors) or, installed, ``skyroute-job`` / ``python -m skyroute``.
The cluster's own session settings are used, completed by those of
``skyroute.session``; ``--master`` is only for local runs. Every job is a thin
argument layer over the library.

  unzip           archives (.zip of .csv) -> gzip text chunks (+ error report)
  load            75-column on-time CSV -> typed Parquet (status=ok|rejected, year)
  load-survey     34-column survey CSV -> 6-column filtered CSV
  top-airports    Q1.1   popularity   Q3.1   top-airlines   Q1.2
  carriers-by-origin Q2.1   dests-by-origin Q2.2   carriers-by-path Q2.3
  weekday         QDOW   two-leg      Q3.2   survey-top     QOD
  lookup          point lookup on a published table (key=value ...)
  produce         CSV lines -> messages on a topic (chunked or one per line)
  stream          streaming form of a question from kafka / socket / files
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from skyroute.operators.aggregate import tokens
from skyroute.operators.flights import REJECT, accepted, parse_flights, rejected
from skyroute.plans import questions as q
from skyroute.sources import csv as csvsrc
from skyroute.session import cluster_session, get_spark, scratch_path
from skyroute.sources.ingest import archive_errors, archive_lines, write_text_chunks
from skyroute.sources.messages import (
    DEFAULT_CHUNK, flights_from_lines, lines_from_messages, to_messages, with_positions,
    write_messages_kafka,
)
from skyroute.sources.keyed import publish_keyed
from skyroute.sources.records import RAW_LINE
from skyroute.sources.tables import lookup, publish
from skyroute.streaming import running as R
from skyroute.streaming.questions import STREAMED, stream_question
from skyroute.streaming.sources import stream_source
from skyroute.streaming.two_leg import TRIP_KEY


def _session(args) -> SparkSession:
    return get_spark(master=args.master) if args.master else cluster_session(f"skyroute-{args.job}")


def _flights(spark, path: str) -> DataFrame:
    return csvsrc.read_stored_flights(spark, path)


def _names(spark, path: str | None):
    return csvsrc.read_lookup(spark, path) if path else None


def _emit(df: DataFrame, args, partition: str | None = None) -> None:
    """Write the result (published by key when asked) and show the first rows."""
    if args.output:
        if partition and getattr(args, "keyed", False):
            publish_keyed(df, args.output, [partition], [partition, "rank"])
        elif partition:
            publish(df, args.output, partition)
        else:
            df.write.mode("overwrite").parquet(args.output)
    if args.show:
        df.show(args.show, truncate=False)


BATCH = {
    "top-airports": (lambda s, a: q.top_airports(_flights(s, a.flights), a.k), None),
    "popularity": (lambda s, a: q.popularity_rank(_flights(s, a.flights)), None),
    "top-airlines": (lambda s, a: q.top_airlines(_flights(s, a.flights), _names(s, a.lookup),
                                                 a.k), None),
    "carriers-by-origin": (lambda s, a: q.top_carriers_by_origin(
        _flights(s, a.flights), _names(s, a.lookup), a.k), "origin"),
    "dests-by-origin": (lambda s, a: q.top_dests_by_origin(_flights(s, a.flights), a.k), "origin"),
    "carriers-by-path": (lambda s, a: q.top_carriers_by_path(
        _flights(s, a.flights), _names(s, a.lookup), a.k), "origin"),
    "weekday": (lambda s, a: q.weekday_delay(_flights(s, a.flights), a.year), None),
    "two-leg": (lambda s, a: q.best_trips(_flights(s, a.flights), a.year), "origin1"),
}


def run_batch(spark, args) -> None:
    build, part = BATCH[args.job]
    df = build(spark, args)
    if args.job == "two-leg" and args.output:
        if args.keyed:
            publish_keyed(df, args.output, [part], TRIP_KEY)
        else:
            publish(df, args.output, part, cluster=False)
        if args.show:
            df.show(args.show, truncate=False)
        return
    _emit(df, args, part)


def run_stream(spark, args) -> None:
    """Streaming question over a message source (values = CSV lines, chunked)."""
    from skyroute.streaming.two_leg import stream_two_leg_incremental
    rejects = None
    if args.source == "files":
        src = stream_source(spark, "text", args.path, max_files_per_trigger=args.files_per_trigger)
    elif args.source == "kafka":
        src = stream_source(spark, "kafka", servers=args.servers, topic=args.topic,
                            group_id=args.group, maxOffsetsPerTrigger=args.offsets_per_trigger)
    else:
        src = stream_source(spark, "socket", host=args.host, port=args.port)
    if args.question == "wordcount":
        words = tokens(src, "value", args.sep)
        query = R.running_counts(words, "word", args.output, args.checkpoint,
                                 trigger=args.trigger, base_root=args.output + "_base",
                                 compact_every=args.compact_every,
                                 seed=spark.read.parquet(args.seed) if args.seed else None)
    else:
        parsed = parse_flights(flights_from_lines(lines_from_messages(src)))
        if args.rejects:
            # a query of its own, with its own checkpoint: the source is read a second time
            rejects = R.per_batch(rejected(parsed).select(REJECT, RAW_LINE), lambda b: b, args.rejects,
                                  args.checkpoint + "_rejects", args.trigger)
        flights = accepted(parsed)
        if args.question == "two-leg":
            query = stream_two_leg_incremental(flights, args.year, args.output + "_legs",
                                               args.output, args.checkpoint,
                                               trigger=args.trigger)
        else:
            query = stream_question(args.question, flights, _names(spark, args.lookup), args.output,
                                    args.checkpoint, args.k, args.trigger)
    try:
        R.run(query)
    finally:
        if rejects:
            R.run(rejects, None if args.trigger == "available_now" else 0)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="skyroute.jobs")
    p.add_argument("--master", default=None, help="local runs only, e.g. local[8]")
    p.add_argument("--show", type=int, default=0, help="print the first n result rows")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("unzip")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--lines-per-file", type=int, default=1_000_000)

    for name in ("load", "load-survey"):
        s = sub.add_parser(name)
        s.add_argument("--input", required=True)
        s.add_argument("--output", required=True)

    for name in BATCH:
        s = sub.add_parser(name)
        s.add_argument("--flights", required=True, help="table written by 'load'")
        s.add_argument("--output", default=None)
        s.add_argument("--keyed", action="store_true",
                       help="publish per-origin results as a keyed table: readers see the old table or the new")
        s.add_argument("--lookup", default=None, help="airline (code, description) CSV")
        s.add_argument("--k", type=int, default=10)
        s.add_argument("--year", type=int, default=2008)

    s = sub.add_parser("survey-top")
    s.add_argument("--survey", required=True, help="6-column filtered survey CSV")
    s.add_argument("--output", default=None)
    s.add_argument("--k", type=int, default=10)

    s = sub.add_parser("lookup")
    s.add_argument("--table", required=True)
    s.add_argument("--order", default="rank")
    s.add_argument("--limit", type=int, default=None)
    s.add_argument("key", nargs="+", help="column=value")

    s = sub.add_parser("produce")
    s.add_argument("--input", required=True, help="folder of CSV text files (recursive)")
    s.add_argument("--servers", required=True)
    s.add_argument("--topic", required=True)
    s.add_argument("--chunk", type=int, default=DEFAULT_CHUNK, help="lines per message")
    s.add_argument("--line", action="store_true", help="one message per line")

    s = sub.add_parser("stream")
    s.add_argument("question", choices=[*STREAMED, "two-leg", "wordcount"])
    s.add_argument("--source", choices=["kafka", "socket", "files"], default="kafka")
    s.add_argument("--path", help="folder of message files (source=files)")
    s.add_argument("--servers")
    s.add_argument("--topic")
    s.add_argument("--group")
    s.add_argument("--host")
    s.add_argument("--port", type=int)
    s.add_argument("--files-per-trigger", type=int, default=1)
    s.add_argument("--offsets-per-trigger", type=int, default=1_000_000, help="messages per micro-batch")
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger", default="30 seconds", help="'available_now' or an interval")
    s.add_argument("--lookup", default=None)
    s.add_argument("--k", type=int, default=10)
    s.add_argument("--year", type=int, default=2008)
    s.add_argument("--sep", default=" ")
    s.add_argument("--compact-every", type=int, default=100)
    s.add_argument("--rejects", help="table of the lines that are no flights, with the reasons")
    s.add_argument("--seed", help="table of (word, count) that word counts start from")

    args = p.parse_args(argv)
    spark = _session(args)
    if args.job == "unzip":
        lines = archive_lines(spark, args.input)
        write_text_chunks(lines, args.output, args.lines_per_file)
        archive_errors(lines).write.mode("overwrite").json(args.output + "_errors")
    elif args.job == "load":
        csvsrc.ingest_ontime(spark, args.input, args.output)
    elif args.job == "load-survey":
        csvsrc.write_csv(csvsrc.filter_survey(csvsrc.read_survey_raw(spark, args.input)),
                         args.output)
    elif args.job in BATCH:
        run_batch(spark, args)
    elif args.job == "survey-top":
        _emit(q.survey_top(csvsrc.read_survey_filtered(spark, args.survey), args.k), args)
    elif args.job == "lookup":
        key = dict(kv.split("=", 1) for kv in args.key)
        lookup(spark, args.table, order=args.order, limit=args.limit, **key).show(
            args.show or 20, truncate=False)
    elif args.job == "produce":
        lines = with_positions(csvsrc.read_lines(spark, args.input), scratch_path(spark, "lines"))
        msgs = to_messages(lines, 1 if args.line else args.chunk)
        write_messages_kafka(msgs, args.servers, args.topic)
    elif args.job == "stream":
        run_stream(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
