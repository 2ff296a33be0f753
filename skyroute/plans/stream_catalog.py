"""Registered streaming, message and lookup queries (same answers as batch)."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.operators.aggregate import tokens, wordcount
from skyroute.operators.flights import accepted, parse_flights
from skyroute.plans import fixture as fx
from skyroute.plans import questions as q
from skyroute.plans.catalog import (
    FLIGHTS_CTE, TOP_CARRIERS_BY_ORIGIN_SQL, TOP_CARRIERS_BY_PATH_SQL, TOP_DESTS_BY_ORIGIN_SQL,
    TRIP_YEAR, TWO_LEG_BEST_SQL, ORACLE_SQL, register,
)
from skyroute.plans.replay import N_BATCHES, document_streams, flight_line_streams
from skyroute.session import scratch_path
from skyroute.sources.messages import (
    as_kept_layout, flights_from_lines, lines_from_messages, to_csv_lines, to_messages,
    with_positions,
)
from skyroute.sources.keyed import KeyedTable
from skyroute.sources.tables import lookup, publish
from skyroute.sources.versions import read_text, remove
from skyroute.streaming import running as R
from skyroute.streaming.control import drain_until_marker
from skyroute.streaming.partials import merge_partials, merge_partials_stream, read_merged, stage_partials
from skyroute.streaming.recover import rebuild, state_rows
from skyroute.streaming.questions import read_answer, stream_question
from skyroute.streaming.two_leg import stream_two_leg_incremental as _stream_two_leg

SEED = (("hello", 1), ("world", 1))  # fixed value: the initial word counts

WORDCOUNT_SQL = """
select word, count(*) as count from (
  select unnest(string_split(text, ' ')) as word from documents) group by word"""


def _dirs(spark, name):
    return scratch_path(spark, name + "-out"), scratch_path(spark, name + "-ckpt")


# -- word counts over a stream of documents ----------------------------------

@register("stream_wordcount_batch", f"""
select batch, word, count(*) as count from (
  select coalesce(doc_id % {N_BATCHES}, 0) as batch, unnest(string_split(text, ' ')) as word from documents)
group by batch, word""")
def stream_wordcount_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = _dirs(spark, "wc-batch")
    fn = lambda b: (b.select("batch", F.explode(F.split("text", " ", -1)).alias("word"))
                     .groupBy("batch", "word").agg(F.count(F.lit(1)).alias("count")))
    R.drain(document_streams(spark, sf_dir), lambda s: R.per_batch(s, fn, out, ck))
    return spark.read.parquet(out).select(F.col("batch").cast("bigint").alias("batch"),
                                          "word", "count")


@register("stream_wordcount_running", WORDCOUNT_SQL)
def stream_wordcount_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = _dirs(spark, "wc-running")
    base = scratch_path(spark, "wc-running-base")
    R.drain(document_streams(spark, sf_dir), lambda s: R.running_counts(
        tokens(s, "text"), "word", out, ck, base_root=base, compact_every=2))
    return R.current(spark, out, "word", base_root=base).select("word", "count")


@register("stream_wordcount_seeded", f"""
with c as ({WORDCOUNT_SQL}),
seed as (select * from (values ('hello', 1), ('world', 1)) as s(word, n))
select coalesce(c.word, seed.word) as word,
  cast(coalesce(c.count, 0) + coalesce(seed.n, 0) as bigint) as count
from c full outer join seed on c.word = seed.word""")
def stream_wordcount_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = _dirs(spark, "wc-seeded")
    seed = spark.createDataFrame(list(SEED), "word string, count long")
    R.drain(document_streams(spark, sf_dir),
            lambda s: R.running_counts(tokens(s, "text"), "word", out, ck, seed=seed))
    return R.current(spark, out, "word")


@register("stream_restart", WORDCOUNT_SQL)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running word counts whose driver is lost in every batch after its rows are written and before the batch is
    committed; each restart takes the batch up again from the checkpoint."""
    out, ck = _dirs(spark, "wc-restart")
    for i, s in enumerate(document_streams(spark, sf_dir)):
        counts = tokens(s, "text").groupBy("word").agg(F.count(F.lit(1)).alias("count"))

        def lost(b: DataFrame, batch_id: int) -> None:
            R.write_batch(b, out, batch_id)
            raise RuntimeError("the driver is lost")
        for sink in (lost, lambda b, batch_id: R.write_batch(b, out, batch_id)):
            try:
                R.run(R.start(counts, sink, ck))
            except StreamingQueryException as e:
                if "the driver is lost" not in str(e):
                    raise
    return R.current(spark, out, "word")


@register("state_rebuild", WORDCOUNT_SQL)
def state_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published word counts are lost halfway and written anew from the checkpointed state; the stream goes on."""
    out, ck = _dirs(spark, "wc-state")
    streams = document_streams(spark, sf_dir)
    for i, s in enumerate(streams):
        if i == len(streams) // 2:
            remove(spark, out)
            rebuild(state_rows(spark, ck, ["word"], ["count"]), out, spark, ck)
        R.run(R.running_counts(tokens(s, "text"), "word", out, ck))
    return R.current(spark, out, "word")


MARKER_BATCH = 2  # the registered query's marker: any row of this input batch


@register("stream_until_marker", f"""
select word, count(*) as count from (
  select unnest(string_split(text, ' ')) as word from documents
  where coalesce(doc_id % {N_BATCHES}, 0) <= {MARKER_BATCH}) group by word""")
def stream_until_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of the batches up to the one that holds a marker, that batch included."""
    out, ck = _dirs(spark, "wc-marker")

    def sink(b: DataFrame, batch_id: int) -> None:
        R.write_batch(wordcount(b, "text"), out, batch_id)
    drain_until_marker(document_streams(spark, sf_dir), F.col("batch") == MARKER_BATCH, sink, ck)
    return spark.read.parquet(out).groupBy("word").agg(F.sum("count").alias("count"))


# -- running popularity / means with ranked tables ---------------------------

def _streamed(spark, sf_dir, question, named=True):
    out, ck = _dirs(spark, question)
    names = fx.airline_names(spark, sf_dir) if named else None
    R.drain(flight_line_streams(spark, sf_dir), lambda s: stream_question(question, s, names, out, ck))
    return read_answer(spark, question, out)


@register("stream_top_airports", ORACLE_SQL["top_airports"])
def stream_top_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "top-airports", named=False)


@register("stream_top_airlines", ORACLE_SQL["top_airlines"])
def stream_top_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "top-airlines")


@register("stream_mean_carrier", TOP_CARRIERS_BY_ORIGIN_SQL)
def stream_mean_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "carriers-by-origin")


@register("stream_top_dests", TOP_DESTS_BY_ORIGIN_SQL)
def stream_top_dests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "dests-by-origin", named=False)


@register("stream_carriers_by_path", TOP_CARRIERS_BY_PATH_SQL)
def stream_carriers_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "carriers-by-path")


# -- staged partials ---------------------------------------------------------

@register("stage_partials", ORACLE_SQL["mean_delay_by_airline"])
def stage_partials_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = _dirs(spark, "partials")
    done = ~F.col("cancelled") & ~F.col("diverted") & F.col("airline_id").isNotNull()
    R.drain(flight_line_streams(spark, sf_dir),
            lambda s: stage_partials(s.filter(done), ["airline_id"], "arr_delay", out, ck))
    return merge_partials(spark, out, ["airline_id"], "mean_arr_delay")


@register("stage_partials_stream", ORACLE_SQL["mean_delay_by_airline"])
def stage_partials_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stages as streams: after every input batch the second takes what the first stored."""
    out, ck = _dirs(spark, "partials-2")
    final, ck2 = _dirs(spark, "merged-2")
    done = ~F.col("cancelled") & ~F.col("diverted") & F.col("airline_id").isNotNull()
    for s in flight_line_streams(spark, sf_dir):
        R.run(stage_partials(s.filter(done), ["airline_id"], "arr_delay", out, ck))
        # the first input batches can be empty; then nothing is committed yet
        if read_text(spark, f"{out}/commits/{0:012d}") is not None:
            R.run(merge_partials_stream(spark, out, ["airline_id"], final, ck2))
    return read_merged(spark, final, ["airline_id"], "mean_arr_delay")


@register("stage_partials_popularity", FLIGHTS_CTE + "select airport, count from pop")
def stage_partials_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = _dirs(spark, "partials-pop")
    airport = F.explode(F.array("origin", "dest")).alias("airport")
    R.drain(flight_line_streams(spark, sf_dir),
            lambda s: stage_partials(s.select(airport), ["airport"], None, out, ck))
    return merge_partials(spark, out, ["airport"], "count", metric=False)


# -- two-leg trips over a stream ---------------------------------------------

@register("stream_two_leg", TWO_LEG_BEST_SQL)
def stream_two_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = _dirs(spark, "two-leg")
    legs = scratch_path(spark, "two-leg-legs")
    R.drain(flight_line_streams(spark, sf_dir), lambda s: _stream_two_leg(s, TRIP_YEAR, legs, out, ck))
    return KeyedTable.open(spark, out).read()


# -- messages ----------------------------------------------------------------

MESSAGE_LINES = 4  # lines per message in the registered chunking query


@register("message_chunks", f"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) as pos
  from documents)
select doc_id, cast(pos // {MESSAGE_LINES} as bigint) as chunk_no, count(*) as n_lines,
  string_agg(line, chr(10) order by pos) as value
from l group by doc_id, pos // {MESSAGE_LINES}""")
def message_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return to_messages(lines, MESSAGE_LINES, ["doc_id"], "pos", "line")


@register("message_roundtrip", FLIGHTS_CTE + """
select flight_date, airline_id, flight_num, origin, dest, dep_min, arr_min,
  dep_delay, arr_delay, cancelled, cancellation_code, diverted from flights""")
def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = to_csv_lines(as_kept_layout(fx.raw_flights(spark, sf_dir)))
    msgs = to_messages(with_positions(lines, scratch_path(spark, "flight-lines")), chunk=5000)
    typed = accepted(parse_flights(flights_from_lines(lines_from_messages(msgs))))
    return typed.select("flight_date", "airline_id", "flight_num", "origin", "dest", "dep_min",
                        "arr_min", "dep_delay", "arr_delay", "cancelled", "cancellation_code",
                        "diverted")


# -- published tables and point lookups --------------------------------------

LOOKUP_ORIGIN = "NATION_7"
LOOKUP_DEST = "NATION_3"
LOOKUP_TRIP = ("NATION_7", "NATION_19", "NATION_14")


@register("lookup_origin", f"select * from ({TOP_CARRIERS_BY_ORIGIN_SQL}) "
                           f"where origin = '{LOOKUP_ORIGIN}'")
def lookup_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "carriersbyairport")
    publish(q.top_carriers_by_origin(fx.flights(spark, sf_dir), fx.airline_names(spark, sf_dir)),
            path, "origin")
    return lookup(spark, path, origin=LOOKUP_ORIGIN)


@register("lookup_path", f"select * from ({TOP_CARRIERS_BY_PATH_SQL}) "
                         f"where origin = '{LOOKUP_ORIGIN}' and destination = '{LOOKUP_DEST}'")
def lookup_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "carriersbypath")
    publish(q.top_carriers_by_path(fx.flights(spark, sf_dir), fx.airline_names(spark, sf_dir)),
            path, "origin")
    return lookup(spark, path, origin=LOOKUP_ORIGIN, destination=LOOKUP_DEST)


@register("lookup_trip", f"select * from ({TWO_LEG_BEST_SQL}) where origin1 = '{LOOKUP_TRIP[0]}' "
                         f"and dest1 = '{LOOKUP_TRIP[1]}' and dest2 = '{LOOKUP_TRIP[2]}'")
def lookup_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "best2path")
    publish(q.best_trips(fx.flights(spark, sf_dir), TRIP_YEAR), path, "origin1", cluster=False)
    return lookup(spark, path, order=("start_date",), origin1=LOOKUP_TRIP[0],
                  dest1=LOOKUP_TRIP[1], dest2=LOOKUP_TRIP[2])


# -- CSV sink and archive-layout source over the whole table -----------------

@register("csv_ingest_roundtrip", FLIGHTS_CTE + """
select flight_date, airline_id, flight_num, origin, dest, dep_min, arr_min,
  dep_delay, arr_delay, cancelled, cancellation_code, diverted from flights""")
def csv_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights in the 75-column archive layout -> CSV files with a header
    line each -> archive reader (per-file header skip, inner headers
    dropped, 20 columns kept) -> parser."""
    from skyroute.schemas import RAW_NAMES
    from skyroute.sources.csv import filter_ontime, read_ontime_raw, write_csv
    raw = fx.raw_flights(spark, sf_dir)
    have = set(raw.columns)
    wide = raw.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c)
                        for c in RAW_NAMES.values()])
    # header names as the archives carry them
    wide = wide.toDF(*RAW_NAMES.keys())
    path = scratch_path(spark, "ontime-csv")
    write_csv(wide, path, header=True)
    typed = accepted(parse_flights(filter_ontime(read_ontime_raw(spark, path))))
    return typed.select("flight_date", "airline_id", "flight_num", "origin", "dest", "dep_min",
                        "arr_min", "dep_delay", "arr_delay", "cancelled", "cancellation_code",
                        "diverted")


@register("od_csv_top", ORACLE_SQL["od_top"])
def od_csv_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows in the 34-column raw layout -> CSV with a header line per
    file -> survey reader (project, drop inner headers and empty keys) ->
    top-10 airports."""
    from skyroute.schemas import SURVEY_RAW_NAMES
    from skyroute.sources.csv import filter_survey, read_survey_raw, write_csv
    raw = fx.raw_survey(spark, sf_dir)
    have = set(raw.columns)
    wide = raw.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c)
                        for c in SURVEY_RAW_NAMES.values()]).toDF(*SURVEY_RAW_NAMES.keys())
    path = scratch_path(spark, "survey-csv")
    write_csv(wide, path, header=True)
    return q.survey_top(filter_survey(read_survey_raw(spark, path)), 10)
