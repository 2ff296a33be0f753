"""Command-line jobs on small written files (end to end)."""

from skyroute import jobs
from skyroute.plans import questions as q
from skyroute.sources.csv import (
    filter_ontime, read_ontime_filtered, read_ontime_raw, read_stored_flights, write_csv,
)
from skyroute.sources.tables import read_table
from skyroute.streaming.questions import read_answer
from tests.conftest import rows
from tests.test_csv_sources import write_raw_ontime


def test_load_rank_publish_lookup_and_stream(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_raw_ontime(raw / "p.csv")
    lookup_csv = tmp_path / "lookup.csv"
    lookup_csv.write_text('Code,Description\n19805,"American"\n19790,"Delta"\n')
    typed = str(tmp_path / "typed")
    jobs.main(["load", "--input", str(raw), "--output", typed])
    flights = read_stored_flights(spark, typed)
    assert flights.count() == 5

    out = str(tmp_path / "carriersbyairport")
    jobs.main(["carriers-by-origin", "--flights", typed, "--output", out,
               "--lookup", str(lookup_csv)])
    want = rows(q.top_carriers_by_origin(flights), "origin", "airlineid", "depdelay", "rank")
    assert rows(spark.read.parquet(out), "origin", "airlineid", "depdelay", "rank") == want
    jobs.main(["--show", "5", "lookup", "--table", out, "origin=ORD"])
    assert "American" in capsys.readouterr().out

    keyed = str(tmp_path / "keyed")
    for _ in range(2):
        jobs.main(["carriers-by-origin", "--flights", typed, "--output", keyed, "--keyed"])
    assert rows(read_table(spark, keyed), "origin", "airlineid", "depdelay", "rank") == want
    assert jobs.lookup(spark, keyed, origin="ORD").count() == jobs.lookup(spark, out, origin="ORD").count()

    jobs.main(["--show", "3", "top-airports", "--flights", typed])
    assert "ORD" in capsys.readouterr().out

    # streaming: filtered CSV lines as message files, one file per trigger
    lines = tmp_path / "lines"
    write_csv(filter_ontime(read_ontime_raw(spark, str(raw))).coalesce(1), str(lines))
    sout, ck = str(tmp_path / "stream_out"), str(tmp_path / "stream_ck")
    jobs.main(["stream", "carriers-by-origin", "--source", "files", "--path", str(lines),
               "--output", sout, "--checkpoint", ck, "--trigger", "available_now"])
    # the same schema and key as the batch job's table
    assert rows(read_table(spark, sout), "origin", "airlineid", "depdelay", "rank") == want
    assert jobs.lookup(spark, sout, origin="ORD").count() == jobs.lookup(spark, out, origin="ORD").count() > 0
    for question, cols in [("top-airports", ["airport", "count", "rank"]),
                           ("top-airlines", ["airline_id", "mean_arr_delay", "rank"])]:
        qout = str(tmp_path / question)
        jobs.main(["stream", question, "--source", "files", "--path", str(lines), "--output", qout,
                   "--checkpoint", qout + "_ck", "--trigger", "available_now"])
        batch = q.top_airports(flights) if question == "top-airports" else q.top_airlines(flights)
        assert rows(read_answer(spark, question, qout), *cols) == rows(batch, *cols)


def test_launcher_runs_from_another_folder(tmp_path):
    import pathlib
    import subprocess
    import sys
    raw = tmp_path / "raw"
    raw.mkdir()
    write_raw_ontime(raw / "p.csv")
    launcher = pathlib.Path(jobs.__file__).resolve().parents[1] / "run_job.py"
    for job in (["load", "--input", str(raw), "--output", str(tmp_path / "typed")],
                ["--show", "3", "top-airports", "--flights", str(tmp_path / "typed")]):
        done = subprocess.run([sys.executable, str(launcher), "--master", "local[2]", *job], cwd=tmp_path,
                              capture_output=True, text=True, timeout=180)
        assert done.returncode == 0, done.stderr[-2000:]
    assert "ORD" in done.stdout


def test_stream_jobs_wordcount_and_two_leg(spark, tmp_path):
    from skyroute.operators.aggregate import wordcount
    from skyroute.operators.flights import accepted, parse_flights
    from skyroute.operators.trips import best_trips
    from skyroute.streaming.running import current
    from tests.test_trips import LEGS, SCHEMA
    from pyspark.sql import functions as F
    # flights as filtered CSV lines (20-column layout) written from the leg fixture
    legs = spark.createDataFrame(LEGS, SCHEMA)
    def hhmm(c):
        return F.concat(F.lpad((F.col(c) / 60).cast("int").cast("string"), 2, "0"),
                        F.lpad((F.col(c) % 60).cast("string"), 2, "0"))
    kept = legs.select(
        F.col("flight_date").cast("string").alias("flight_date"),
        F.col("airline_id").cast("string").alias("airline_id"),
        F.col("flight_num").cast("string").alias("flight_num"), "origin",
        F.lit("").alias("origin_city_name"), F.lit("").alias("origin_state_name"), "dest",
        F.lit("").alias("dest_city_name"), F.lit("").alias("dest_state_name"),
        hhmm("dep_min").alias("crs_dep_time"), F.lit("0").alias("dep_delay"),
        hhmm("arr_min").alias("crs_arr_time"), F.col("arr_delay").cast("string").alias("arr_delay"),
        F.col("cancelled").cast("int").cast("string").alias("cancelled"), F.lit("").alias("cancellation_code"),
        F.col("diverted").cast("int").cast("string").alias("diverted"),
        *[F.lit("").alias(c) for c in ("crs_elapsed_time", "actual_elapsed_time", "air_time", "distance")])
    lines = str(tmp_path / "lines")
    write_csv(kept.coalesce(1), lines)
    out = str(tmp_path / "trips")
    (tmp_path / "lines" / "bad.csv").write_text("2008-05-01,1,2\n")
    jobs.main(["stream", "two-leg", "--source", "files", "--path", lines, "--output", out,
               "--checkpoint", str(tmp_path / "ck1"), "--trigger", "available_now", "--rejects", str(tmp_path / "rejects")])
    assert rows(spark.read.parquet(str(tmp_path / "rejects")), "reject_reason", "raw_line") == [("short", "2008-05-01,1,2")]
    typed = accepted(parse_flights(read_ontime_filtered(spark, lines)))
    cols = ["origin1", "dest1", "dest2", "startdate", "flightnum1", "flightnum2", "total_delay"]
    assert rows(read_table(spark, out), *cols) == rows(best_trips(typed, 2008), *cols)
    assert rows(best_trips(typed, 2008), *cols) == rows(best_trips(legs, 2008), *cols)

    wc = str(tmp_path / "wc")
    jobs.main(["stream", "wordcount", "--source", "files", "--path", lines, "--sep", ",",
               "--output", wc, "--checkpoint", str(tmp_path / "ck2"), "--trigger", "available_now",
               "--compact-every", "1"])
    want = rows(wordcount(spark.read.text(lines), "value", ","))
    assert rows(current(spark, wc, "word", base_root=wc + "_base")) == want


def test_remaining_batch_jobs(spark, tmp_path, capsys):
    import csv
    import io
    import os
    from skyroute.schemas import SURVEY_RAW_COLUMNS
    from tests.test_ingest import _archives
    # unzip: lines of the csv members as gzip chunks, errors reported
    root = _archives(tmp_path)
    jobs.main(["unzip", "--input", str(root), "--output", str(tmp_path / "chunks"),
               "--lines-per-file", "10"])
    assert any(f.endswith(".gz") for f in os.listdir(tmp_path / "chunks"))
    assert spark.read.json(str(tmp_path / "chunks_errors")).count() == 2
    # survey: load (filter) then top airports
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(SURVEY_RAW_COLUMNS)
    for o, d in [("ORD", "LAX"), ("LAX", "ORD"), ("ORD", "JFK"), ("", "ORD")]:
        r = [""] * len(SURVEY_RAW_COLUMNS)
        r[SURVEY_RAW_COLUMNS.index("Origin")], r[SURVEY_RAW_COLUMNS.index("Dest")] = o, d
        w.writerow(r)
    (tmp_path / "survey").mkdir()
    (tmp_path / "survey" / "s.csv").write_text(buf.getvalue())
    jobs.main(["load-survey", "--input", str(tmp_path / "survey"),
               "--output", str(tmp_path / "survey_f")])
    jobs.main(["survey-top", "--survey", str(tmp_path / "survey_f"),
               "--output", str(tmp_path / "survey_top")])
    assert rows(spark.read.parquet(str(tmp_path / "survey_top")), "airport", "count") == [
        ("JFK", 1), ("LAX", 2), ("ORD", 3)]
    # flights: load, then popularity, weekday, two-leg and dests-by-origin
    raw = tmp_path / "raw"
    raw.mkdir()
    write_raw_ontime(raw / "p.csv")
    typed = str(tmp_path / "typed")
    jobs.main(["load", "--input", str(raw), "--output", typed])
    for job, extra in [("popularity", []), ("weekday", ["--year", "2008"]),
                       ("two-leg", ["--year", "2008"]), ("dests-by-origin", [])]:
        out = str(tmp_path / job)
        jobs.main([job, "--flights", typed, "--output", out, *extra])
        assert os.path.isdir(out)
    assert spark.read.parquet(str(tmp_path / "popularity")).count() == 4
    # flights 1 (Thu) and 8 (Sat) are the only completed ones with known times and delay
    assert rows(spark.read.parquet(str(tmp_path / "weekday")), "day_of_week") == [
        ("Saturday",), ("Thursday",)]
