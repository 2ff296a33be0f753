import csv
import datetime as dt
import io

from skyroute.operators.flights import accepted, rejected
from skyroute.plans import questions as q
from skyroute.schemas import ONTIME_RAW_COLUMNS, SURVEY_RAW_COLUMNS
from skyroute.sources.csv import (
    filter_ontime, filter_survey, ingest_ontime, read_flights_csv, read_ingested, read_lookup,
    read_ontime_raw, read_survey_raw, write_csv,
)
from skyroute.operators.flights import parse_flights
from skyroute.operators.lookup import with_names
from tests.conftest import rows


def _row(**kv):
    out = [""] * len(ONTIME_RAW_COLUMNS)
    for k, v in kv.items():
        out[ONTIME_RAW_COLUMNS.index(k)] = v
    return out


def _flight(date, airline, num, origin, dest, dep, arr, arr_delay, dep_delay="1.00",
            cancelled="0.00", diverted="0.00", code="", city="Chicago, IL"):
    return _row(FlightDate=date, AirlineID=airline, FlightNum=num, Origin=origin, Dest=dest,
                OriginCityName=city, CRSDepTime=dep, CRSArrTime=arr, ArrDelay=arr_delay,
                DepDelay=dep_delay, Cancelled=cancelled, Diverted=diverted, CancellationCode=code)


def write_raw_ontime(path):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(ONTIME_RAW_COLUMNS)
    w.writerow(_flight("2008-01-03", "19805", "1", "ORD", "LAX", "0930", "1130", "5.00"))
    w.writerow(_flight("2008-01-03", "19805", "2", "ORD", "JFK", "2400", "2575", ""))
    w.writerow(list(ONTIME_RAW_COLUMNS))                      # header repeated inside
    hdr_one = _flight("FlightDate", "19790", "3", "LAX", "ORD", "1000", "1200", "-4.00")
    w.writerow(hdr_one)                                        # only one column equal: kept
    w.writerow(_flight("2008-02-30", "19805", "4", "ORD", "LAX", "0930", "1130", "5.00"))
    w.writerow(_flight("2008-01-04", "abc", "5", "ORD", "LAX", "0930", "1130", "5.00"))
    w.writerow(_flight("2008-01-04", "19790", "6", "LAX", "SFO", "0800", "0900", "",
                       dep_delay="", cancelled="1.00", code="B"))
    w.writerow(_flight("2008-01-04", "19790", "7", "LAX", "SFO", "0800", "0900", "",
                       diverted="1.00", code='"'))
    w.writerow(_flight("2008-01-05", "20355", "8", "SFO", "ORD", "1300", "2100", "-2.00"))
    with open(path, "w") as f:
        f.write(buf.getvalue())


def test_raw_ontime_to_typed(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    write_raw_ontime(src / "part1.csv")
    raw = read_ontime_raw(spark, str(src))
    kept = filter_ontime(raw)
    assert len(kept.columns) == 20
    parsed = parse_flights(kept)
    good = accepted(parsed)
    assert sorted(r.flight_num for r in good.collect()) == [1, 2, 6, 7, 8]
    # the header-like row with only one column equal stays, then is rejected (bad date)
    reasons = sorted(r.reject_reason for r in rejected(parsed).collect())
    assert reasons == ["airline_id", "flight_date", "flight_date"]
    by = {r.flight_num: r for r in good.collect()}
    assert by[1].origin_city_name == "Chicago, IL"
    assert by[2].dep_min == 0 and by[2].arr_min is None and by[2].arr_delay is None
    assert by[6].cancelled and by[6].cancellation_code == "B"
    assert by[7].diverted and by[7].cancellation_code is None


def test_filtered_csv_roundtrip_keeps_every_row(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    write_raw_ontime(src / "p.csv")
    kept = filter_ontime(read_ontime_raw(spark, str(src)))
    out = str(tmp_path / "filtered")
    write_csv(kept.repartition(3), out)
    back = read_flights_csv(spark, out)               # headerless files: nothing skipped
    assert back.count() == kept.count() == 8
    assert rows(back.drop("reject_reason", "raw_line")) == rows(parse_flights(kept).drop("reject_reason"))
    # a lone quote code survives the write as the quoted form and reads back as null
    by = {r.flight_num: r for r in accepted(back).collect()}
    assert by[7].cancellation_code is None


def test_ingest_single_pass(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    write_raw_ontime(src / "p.csv")
    out = str(tmp_path / "typed")
    ingest_ontime(spark, str(src), out)
    assert read_ingested(spark, out).count() == 5
    assert read_ingested(spark, out, "rejected").count() == 3
    assert {r.flight_date for r in read_ingested(spark, out).collect()} == {
        dt.date(2008, 1, 3), dt.date(2008, 1, 4), dt.date(2008, 1, 5)}


def test_survey_cleanup(spark, tmp_path):
    def srow(o, d):
        out = [""] * len(SURVEY_RAW_COLUMNS)
        out[SURVEY_RAW_COLUMNS.index("Origin")] = o
        out[SURVEY_RAW_COLUMNS.index("Dest")] = d
        out[SURVEY_RAW_COLUMNS.index("OriginCountry")] = "US"
        return out
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(SURVEY_RAW_COLUMNS)
    for o, d in [("ORD", "LAX"), ("LAX", "ORD"), ("ORD", "JFK"), ("", "ORD"), ('""', "LAX"),
                 ("ORD", ""), ("ATL", "ORD")]:
        w.writerow(srow(o, d))
    w.writerow(SURVEY_RAW_COLUMNS)
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text(buf.getvalue() + ',,,,,,"",,,,,,,,ORD' + "," * 19 + "\n")
    clean = filter_survey(read_survey_raw(spark, str(tmp_path / "s")))
    assert rows(clean, "origin", "dest") == [("ATL", "ORD"), ("LAX", "ORD"), ("ORD", "JFK"),
                                             ("ORD", "LAX")]
    top = q.survey_top(clean, 2)
    assert rows(top, "airport", "count", "rank") == [("LAX", 2, 2), ("ORD", 4, 1)]


def test_lookup_csv_names(spark, tmp_path):
    p = tmp_path / "lookup.csv"
    p.write_text('Code,Description\n19805,"American Airlines Inc.: AA"\n'
                 '19790,"Delta Air Lines Inc.: DL"\n20355,"US Airways, Inc."\nXX1,"Bad code"\n')
    names = read_lookup(spark, str(p))
    df = spark.createDataFrame([(19805, 1.0), (20355, 2.0), (11111, 3.0)], "airline_id long, m double")
    got = rows(with_names(df, names, "airline_id"), "airline_id", "name")
    assert got == [(11111, None), (19805, "American Airlines Inc.: AA"), (20355, "US Airways, Inc.")]


def test_text_scan_and_export_import(spark, tmp_path):
    from skyroute.sources.csv import export_table, import_table, read_flights_text
    from skyroute.plans import questions as qq
    src = tmp_path / "raw"
    src.mkdir()
    write_raw_ontime(src / "p.csv")
    kept = filter_ontime(read_ontime_raw(spark, str(src)))
    out = str(tmp_path / "filtered")
    write_csv(kept, out)
    via_text = accepted(read_flights_text(spark, out))
    assert rows(via_text) == rows(accepted(read_flights_csv(spark, out)))
    top = qq.top_carriers_by_origin(via_text)
    exp = str(tmp_path / "export")
    export_table(top, ["origin", "airlineid", "depdelay", "rank"], exp)
    back = import_table(spark, "origin string, airlineid long, depdelay double, rank int", exp)
    assert rows(back) == rows(top, "origin", "airlineid", "depdelay", "rank")


FAULTS = {  # of lines with four fields
    "a,b,c,d": None, ",,,": None, 'a,"b,c",d,"e"': None, '"","x ""y"" z",,""""': None, "a,b,c,d,": None, "a,b,c,d,,": None,
    'a,b,c,d,""': "long", "a,b,c": "short", "": None, "abc": "short", '"a,b,c,d"': "short", "a,b,c,d,e": "long",
    "a,b,c,d,,e": "long", 'a,b,c,d,"e"': "long", 'a,"b,c,d': "quotes", 'a,b"c,d,e': "quotes", 'a,"b"c,d,e': "quotes",
    'a,"b" ,c,d': "quotes", 'a,b,c,"': "quotes", 'a,""b,c,d': "quotes", 'a,"b""","c"",d': "quotes",
}


def test_faults_of_lines(spark):
    from pyspark.sql import functions as F
    from skyroute.sources.records import line_fault
    df = spark.createDataFrame([(k, v) for k, v in FAULTS.items() if k], "line string, want string")
    got = {r.line: r.got for r in df.select("line", line_fault(F.col("line"), 4).alias("got")).collect()}
    assert got == {k: v for k, v in FAULTS.items() if k}
    long = '"' + "x" * 200_000 + '""' * 50_000 + '",b,c,d'
    one = spark.createDataFrame([(long,)], "line string")
    assert one.select(line_fault(F.col("line"), 4)).first()[0] is None


def test_malformed_lines_are_rejected_everywhere(spark, tmp_path):
    """Scan, text scan, messages, the load job's table and a stream: the same faults, with the line."""
    from skyroute.sources.csv import read_flights_text
    from skyroute.sources.messages import flights_from_lines
    from skyroute.streaming import running as R
    from skyroute.streaming.sources import stream_source
    src = tmp_path / "raw"
    src.mkdir()
    write_raw_ontime(src / "p.csv")
    good = accepted(parse_flights(filter_ontime(read_ontime_raw(spark, str(src)))))
    kept = str(tmp_path / "kept")
    write_csv(filter_ontime(read_ontime_raw(spark, str(src))).where("flight_num = '1'"), kept)
    line = "".join(open(f).read() for f in map(str, (tmp_path / "kept").glob("part-*.csv"))).strip()
    bad = {line.rsplit(",", 1)[0]: "short", line + ",XXXX,YY": "long", line.replace("ORD", 'O"RD'): "quotes"}
    (tmp_path / "kept" / "bad.csv").write_text("\n".join([*bad, "", line + ","]) + "\n")
    want = sorted((v, k) for k, v in bad.items())
    messages = spark.createDataFrame([("\n".join(bad),)], "value string")
    from skyroute.sources.messages import lines_from_messages
    for parsed, n_good in ((read_flights_csv(spark, kept), 2), (read_flights_text(spark, kept), 2),
                           (parse_flights(flights_from_lines(lines_from_messages(messages))), 0)):
        assert rows(rejected(parsed), "reject_reason", "raw_line") == want
        assert accepted(parsed).count() == n_good and "raw_line" not in accepted(parsed).columns
    out = str(tmp_path / "rejects")
    lines = stream_source(spark, "text", kept).withColumnRenamed("value", "line")
    R.run(R.per_batch(lines, lambda b: rejected(parse_flights(flights_from_lines(b))), out, str(tmp_path / "ck")))
    assert rows(spark.read.parquet(out), "reject_reason", "raw_line") == want
    # the archive layout, as the load job reads it
    wide = (src / "p.csv").read_text().splitlines()[1]
    (src / "bad.csv").write_text(wide + ",,\n" + wide + ",z\n" + wide[:-3] + "\n")
    ingest_ontime(spark, str(src), str(tmp_path / "typed"))
    assert read_ingested(spark, str(tmp_path / "typed")).count() == good.count() + 1
    faults = read_ingested(spark, str(tmp_path / "typed"), "rejected").where("reject_reason in ('long', 'short')")
    assert rows(faults, "reject_reason", "raw_line") == [("long", wide + ",z"), ("short", wide[:-3])]


def test_files_of_the_load_follow_their_size(spark, tmp_path):
    """One file or few for a year, however many tasks read the input."""
    src = tmp_path / "raw"
    src.mkdir()
    for i in range(6):
        write_raw_ontime(src / f"part{i}.csv")
    out = tmp_path / "typed"
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # a task for each file
    try:
        ingest_ontime(spark, str(src), str(out))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list((out / "status=ok" / "year=2008").glob("*.parquet"))) == 1
    assert read_ingested(spark, str(out)).count() == 30


def test_a_line_is_parsed_once_whatever_is_asked_of_its_fields(spark):
    from skyroute.operators.flights import accepted, completed_with, parse_flights
    from skyroute.schemas import ONTIME_KEPT_SCHEMA
    from skyroute.sources.records import records

    lines = spark.createDataFrame([("2000-01-02,7,8,A,,,B,,,0910,1.0,1130,2.0,0,\"\"\"\",0,,,,",), ("2000-01-02,x,8",)], "line string")
    done = completed_with(accepted(parse_flights(records(lines, ONTIME_KEPT_SCHEMA))), "arr_delay", "airline_id")
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1 and plan.count("regexp_replace(") == 1
    assert [(r.airline_id, r.dep_min, r.cancellation_code) for r in done.collect()] == [(7, 550, None)]


def test_one_match_tells_sound_lines_and_faults_stay_the_same(spark):
    from pyspark.sql import functions as F

    from skyroute.sources.records import MALFORMED, RAW_LINE, _sound, line_fault, records

    odd = ["a,b,c", "a,,", '"x, ""y""",b,""', '"""",b,c', "a,b", "a,b,c,", "a,b,c,,,", "a,b,c,d", 'a,b,c,""', 'a"b,c,d',
           '"a"b,c,d', '"a,b,c', 'a,b,"c', "a\u0001b,c,d", '"a\u0001b",c,d', 'a\u0001b,"c",d', ",,", ",", 'a,b,c,,"d"', "a,b,é "]
    lines = spark.createDataFrame([(x,) for x in odd], "line string")
    schema = spark.createDataFrame([], "x string, y string, z string").schema
    whole = {r[0]: (r[1], r[2]) for r in lines.select("line", line_fault(F.col("line"), 3), _sound(F.col("line"), 3)).collect()}
    assert {r[0]: r[1] for r in records(lines, schema).select(RAW_LINE, MALFORMED).collect()} == {k: v[0] for k, v in whole.items()}
    assert all(fault is None for fault, sound in whole.values() if sound)
    assert sum(sound for _, sound in whole.values()) >= 8
