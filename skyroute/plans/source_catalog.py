"""Registered queries over the sources and sinks: each writes a driver table in one layout and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.operators.aggregate import tokens
from skyroute.operators.flights import accepted, parse_flights, rejected
from skyroute.operators.lookup import with_names
from skyroute.operators.ranking import number_rows
from skyroute.operators.trips import best_trips
from skyroute.plans import fixture as fx
from skyroute.plans import questions as q
from skyroute.plans.catalog import (
    FLIGHTS_CTE, ORACLE_SQL, TOP_CARRIERS_BY_PATH_SQL, TRIP_YEAR, TWO_LEG_BEST_SQL, register,
)
from skyroute.session import scratch_path
from skyroute.sources import csv as csvsrc
from skyroute.sources.ingest import archive_lines, first_file_per_listing_group, list_input_files
from skyroute.sources.ingest import first_file_per_directory as first_file_of_folder
from skyroute.sources.keyed import KeyedTable, bucket_of
from skyroute.sources.messages import (
    as_kept_layout, flights_from_lines, lines_from_messages, to_csv_lines, to_messages, with_positions,
)
from skyroute.sources.tables import lookup, publish
from skyroute.streaming import running as R
from skyroute.streaming.sources import stream_source

FLIGHT_COLS = ("flight_date", "airline_id", "flight_num", "origin", "dest", "dep_min", "arr_min", "dep_delay",
               "arr_delay", "cancelled", "cancellation_code", "diverted")
_FLIGHTS_SQL = FLIGHTS_CTE + f"select {', '.join(FLIGHT_COLS)} from flights"


@register("csv_filtered_scan", _FLIGHTS_SQL)
def csv_filtered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20-column CSV without header lines -> typed flights."""
    path = scratch_path(spark, "kept-csv")
    csvsrc.write_csv(as_kept_layout(fx.raw_flights(spark, sf_dir)), path)
    return accepted(csvsrc.read_flights_csv(spark, path)).select(*FLIGHT_COLS)


@register("text_scan", _FLIGHTS_SQL)
def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files, parsed as CSV one by one -> typed flights."""
    path = scratch_path(spark, "kept-lines")
    to_csv_lines(as_kept_layout(fx.raw_flights(spark, sf_dir)), "value").write.text(path)
    return accepted(csvsrc.read_flights_text(spark, path)).select(*FLIGHT_COLS)


@register("lookup_csv", ORACLE_SQL["lookup_names"])
def lookup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from a lookup file with a header line."""
    path = scratch_path(spark, "lookup-csv")
    csvsrc.write_csv(fx.airline_names(spark, sf_dir), path, header=True)
    return with_names(q.mean_delay_by_airline(fx.flights(spark, sf_dir)), csvsrc.read_lookup(spark, path), "airline_id")


@register("export_import", _FLIGHTS_SQL)
def export_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table -> CSV with a column list -> table."""
    flights = fx.flights(spark, sf_dir).select(*FLIGHT_COLS)
    path = scratch_path(spark, "export")
    csvsrc.export_table(flights, FLIGHT_COLS, path)
    return csvsrc.import_table(spark, flights.schema, path)


@register("od_inner_headers", ORACLE_SQL["od_clean"])
def od_inner_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines between the survey's rows (one for each nation here) are dropped."""
    raw = fx.raw_survey(spark, sf_dir)
    names = {"origin": "Origin", "dest": "Dest"}
    header = fx.table(spark, sf_dir, "nation").select(*[F.lit(names.get(c, c)).alias(c) for c in raw.columns])
    return csvsrc.filter_survey(raw.unionByName(header))


_SAME_REGION = "(select x.n_name, y.n_name from nation x join nation y on x.n_regionkey = y.n_regionkey)"


@register("two_leg_allowed", TWO_LEG_BEST_SQL.replace(
    "a.flight_date = b.flight_date - 2)", f"a.flight_date = b.flight_date - 2 where (a.origin, a.dest) in {_SAME_REGION} "
    f"and (b.origin, b.dest) in {_SAME_REGION})"))
def two_leg_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips over listed routes only: here those inside one region."""
    nation = fx.table(spark, sf_dir, "nation")
    x = nation.select("n_regionkey", F.col("n_name").alias("origin"))
    y = nation.select("n_regionkey", F.col("n_name").alias("dest"))
    routes = x.join(y, "n_regionkey").select("origin", "dest")
    return best_trips(fx.flights(spark, sf_dir), TRIP_YEAR, first_routes=routes, second_routes=routes)


@register("stream_wordcount_text", """
select word, count(*) as count from (select unnest(string_split(line, ' ')) as word
  from (select unnest(string_split(text, chr(10))) as line from documents)) group by word""")
def stream_wordcount_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running word counts over a folder of text files."""
    path, out, ck = (scratch_path(spark, f"wc-text-{x}") for x in ("in", "out", "ckpt"))
    fx.table(spark, sf_dir, "documents").select("text").write.text(path)
    words = tokens(stream_source(spark, "text", path, lineSep="\n"), "value")
    R.run(R.running_counts(words, "word", out, ck))
    return R.current(spark, out, "word")


# -- malformed lines ----------------------------------------------------------

def _spoiled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line): flights in the 20-column layout (only a lone quote needs quoting); by flight number mod 97, 1 lacks
    the last field, 2 has one more and 3 a quote that is never closed."""
    kept = as_kept_layout(fx.raw_flights(spark, sf_dir))
    quoted = [F.when(F.col(c) == '"', F.lit('""""')).otherwise(F.coalesce(F.col(c), F.lit("")))
              for c in kept.columns]
    line, k = F.concat_ws(",", *quoted), F.col("flight_num").cast("long") % 97
    return kept.select(F.when(k == 1, F.regexp_replace(line, ",[^,]*$", "")).when(k == 2, F.concat(line, F.lit(",surplus")))
                       .when(k == 3, F.concat(F.lit('"'), line)).otherwise(line).alias("line"))


_LINES_CTE = FLIGHTS_CTE + """, lines as (
  select cast(flight_num as bigint) % 97 as k, concat_ws(',', flight_date, airline_id, flight_num, origin, '', '', dest, '', '',
    crs_dep_time, dep_delay, crs_arr_time, arr_delay, cancelled,
    case cancellation_code when '"' then repeat('"', 4) else cancellation_code end, diverted, '', '', '', '') as line
  from raw_flights)
"""


@register("csv_rejects", _LINES_CTE + """
select case k when 1 then 'short' when 2 then 'long' else 'quotes' end as reject_reason,
  case k when 1 then left(line, length(line) - 1) when 2 then line || ',surplus' else '"' || line end as raw_line
from lines where k in (1, 2, 3)""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short, long and badly quoted lines among the flights' lines -> the rejects, with their lines."""
    path = scratch_path(spark, "spoiled-lines")
    _spoiled_lines(spark, sf_dir).write.text(path)
    return rejected(csvsrc.read_flights_csv(spark, path)).select("reject_reason", "raw_line")


@register("csv_rejects_accepted", _FLIGHTS_SQL + " where flight_num % 97 not in (1, 2, 3)")
def csv_rejects_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights beside those malformed lines, read as messages: every sound line, and no other."""
    placed = with_positions(_spoiled_lines(spark, sf_dir), scratch_path(spark, "spoiled-messages"))
    messages = to_messages(placed, 1000)
    return accepted(parse_flights(flights_from_lines(lines_from_messages(messages)))).select(*FLIGHT_COLS)


# -- archives and listings ------------------------------------------------------

def _write_archives(lines: DataFrame, folder: str) -> None:
    """(archive, member, pos, line) -> zip files in ``folder``, an archive by one task, its lines streamed into it.

    Archives named ``cut...`` lose their second half, ones named ``empty...`` everything.
    """
    def write(batches):
        import zipfile

        import pandas as pd
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        at = member = zf = sink = None

        def close():
            if at is None:
                return
            if member is not None:
                member.close()
            zf.close()
            sink.close()
            size = store.get_file_info(f"{root}/{at}").size
            keep = 0 if at.startswith("empty") else size // 2 if at.startswith("cut") else size
            if keep < size:
                with store.open_input_file(f"{root}/{at}") as f:
                    head = f.read(keep)
                with store.open_output_stream(f"{root}/{at}") as f:
                    f.write(head)
        name = None
        for pdf in batches:
            for archive, part, line in zip(pdf["archive"], pdf["member"], pdf["line"], strict=True):
                if archive != at:
                    close()
                    at, name, member = archive, None, None
                    sink = store.open_output_stream(f"{root}/{archive}")
                    zf = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                if part != name:
                    if member is not None:
                        member.close()
                    name, member = part, zf.open(part, "w", force_zip64=True)
                member.write(line.encode() + b"\n")
        close()
        yield pd.DataFrame({"done": [True]})

    spread = lines.repartition("archive").sortWithinPartitions("archive", "member", "pos")
    spread.select("archive", "member", "line").mapInPandas(write, "done boolean").write.format("noop").mode("overwrite").save()


@register("archive_roundtrip", FLIGHTS_CTE + """
, a as (select case origin when 'NATION_3' then 'cut_' when 'NATION_5' then 'empty_' else '' end || origin || '.zip' as archive,
  dest || '.csv' as member, concat_ws(',', flight_date, flight_num, airline_id) as line from flights)
select archive, member, line, false as damaged from a where archive not like 'cut%' and archive not like 'empty%'
union all select distinct archive, null, null, true from a where archive like 'cut%' or archive like 'empty%'""")
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights -> CSV members, one a destination, of zip archives, one an origin, two of them damaged -> their lines
    back, and an error for each damaged one."""
    origin = F.col("origin")
    flights = fx.flights(spark, sf_dir)
    line = F.concat_ws(",", F.col("flight_date").cast("string"), "flight_num", "airline_id")
    lines = flights.select(
        F.concat(F.when(origin == "NATION_3", "cut_").when(origin == "NATION_5", "empty_").otherwise(""), origin,
                 F.lit(".zip")).alias("archive"),
        F.concat("dest", F.lit(".csv")).alias("member"), line.alias("pos"), line.alias("line"))
    folder = _with_scheme(spark, scratch_path(spark, "archives"))
    _write_archives(lines, folder)
    back = archive_lines(spark, folder)
    return back.select(F.regexp_extract("archive", "[^/]*$", 0).alias("archive"), "member", "line",
                       F.col("error").isNotNull().alias("damaged"))


def _with_scheme(spark: SparkSession, path: str) -> str:
    """``path`` as a URI of the store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString().replace("file:/", "file:///", 1)


@register("first_file_per_directory", """
select coalesce(source, 'none') as directory, min(doc_id) as first_doc, count(*) as files from documents group by 1""")
def first_file_per_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recursive listing as text (directories, each followed by its files) -> the first file of every directory, and
    the number of files in it."""
    docs = fx.table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("none")).alias("d"), "doc_id")
    path = scratch_path(spark, "listing")
    files = docs.select("d", "doc_id", F.format_string("/data/%s/doc_%012d.txt", "d", "doc_id").alias("value"))
    folders = docs.select("d").distinct().select("d", F.lit(-1).cast("long").alias("doc_id"),
                                                 F.concat(F.lit("/data/"), "d").alias("value"))
    (files.unionByName(folders).orderBy("d", "doc_id").select("value").write.text(path))
    first = first_file_per_listing_group(spark, path)
    parts = F.regexp_extract("first_file", "^/data/(.*)/doc_0*([0-9]+)[.]txt$", 1)
    counts = spark.read.text(path).where("value like '%.txt'").groupBy(
        F.regexp_extract("value", "^/data/(.*)/[^/]*$", 1).alias("directory")).agg(F.count(F.lit(1)).alias("files"))
    return (first.select(parts.alias("directory"), F.regexp_extract("first_file", "doc_([0-9]+)", 1).cast("long").alias("first_doc"))
            .join(counts, "directory"))


@register("listed_files", """
select source as directory, true as has_files, count(*) as documents from documents where source is not null group by source""")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of documents, listed recursively (paths and sizes only): every folder has a first file, and the files
    that are listed hold all documents."""
    docs = fx.table(spark, sf_dir, "documents").where("source is not null").select("source", "doc_id")
    path = scratch_path(spark, "folders")
    docs.write.partitionBy("source").json(path)
    listed = list_input_files(spark, path)
    first = first_file_of_folder(listed).select(
        F.regexp_extract("directory", "source=([^/]*)$", 1).alias("directory"), F.col("first_file").isNotNull().alias("has_files"))
    held = spark.read.schema("doc_id long, source string").json(path).groupBy(F.col("source").alias("directory")).agg(
        F.count(F.lit(1)).alias("documents"))
    return first.join(held, "directory")


# -- keyed tables and total order ---------------------------------------------

@register("keyed_upsert", FLIGHTS_CTE + """
, early as (select origin, airline_id, count(*) as flights, max(flight_date) as newest from flights
  where flight_date < date '1998-01-01' group by 1, 2),
late as (select origin, airline_id, count(*) as flights, max(flight_date) as newest from flights
  where flight_date >= date '1998-01-01' and airline_id % 3 = 0 group by 1, 2)
select coalesce(l.origin, e.origin) as origin, coalesce(l.airline_id, e.airline_id) as airline_id,
  coalesce(l.flights, e.flights) as flights, coalesce(l.newest, e.newest) as newest
from early e full join late l on e.origin = l.origin and e.airline_id = l.airline_id""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of (origin, airline) from the early flights, then the rows of a third of the airlines upserted from the
    late ones: other rows of the same parts stay."""
    flights, day = fx.flights(spark, sf_dir), F.lit("1998-01-01").cast("date")

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("origin", "airline_id").agg(F.count(F.lit(1)).alias("flights"), F.max("flight_date").alias("newest"))
    early = counted(flights.where(F.col("flight_date") < day))
    late = counted(flights.where((F.col("flight_date") >= day) & (F.col("airline_id") % 3 == 0)))
    table = KeyedTable(spark, scratch_path(spark, "keyed"), early.schema, ["origin", "airline_id"], bucket_of(["origin"], 16))
    table.upsert(early)
    table.upsert(late)
    return KeyedTable.open(spark, table.path).read()


_NUMBERED = ("flight_num", "airline_id", "origin", "dest", "flight_date", "arr_delay")


@register("flights_numbered", FLIGHTS_CTE + f"""
select {', '.join(_NUMBERED)}, row_number() over (order by arr_delay desc nulls last, flight_date, flight_num, airline_id,
  origin, dest) as row_number from flights""")
def flights_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flights in the total order of their delay, numbered."""
    order = [F.col("arr_delay").desc_nulls_last(), "flight_date", "flight_num", "airline_id", "origin", "dest"]
    return number_rows(fx.flights(spark, sf_dir).select(*_NUMBERED), order)


LOOKUP_DEST = "NATION_3"


@register("lookup_dest", f"select * from ({TOP_CARRIERS_BY_PATH_SQL}) where destination = '{LOOKUP_DEST}'")
def lookup_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup by a column that is not the partition key: files sorted by it and with bloom filters."""
    path = scratch_path(spark, "carriersbypath-sorted")
    publish(q.top_carriers_by_path(fx.flights(spark, sf_dir), fx.airline_names(spark, sf_dir)), path, "origin",
            sort=["destination", "rank"], bloom=["destination", "airlineid"])
    return lookup(spark, path, order=("origin", "rank"), destination=LOOKUP_DEST)
