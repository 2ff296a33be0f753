"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query callable takes (spark, sf_dir) and returns a DataFrame; the oracle
is an independent SQL text over the same tables (FIXTURES.md), never used by
the Spark side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.functions.parse import hhmm_minutes
from skyroute.operators.aggregate import wordcount as _wordcount
from skyroute.operators.flights import completed_with
from skyroute.operators.lookup import with_names
from skyroute.plans import fixture as fx
from skyroute.plans import questions as q

TRIP_YEAR = 2000  # the fixture's dates span 1995-2001

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# Oracle building blocks (DuckDB dialect)
RX = "^(2[0-3]|[0-1][0-9]|[0-9])([0-5][0-9]|[0-9])$"


def _minutes(c: str) -> str:
    t = f"replace({c},'2400','0000')"
    return (f"case when regexp_matches({t}, '{RX}') then "
            f"cast(regexp_extract({t}, '{RX}', 1) as int)*60 + "
            f"cast(regexp_extract({t}, '{RX}', 2) as int) end")


FLIGHTS_CTE = f"""
with base as (
  select l.*, o.o_custkey, l_orderkey*37+l_linenumber*101+l_partkey as h
  from lineitem l join orders o on l_orderkey=o_orderkey),
t as (select *, h % 1440 as dm, (h*7+l_suppkey) % 1440 as am from base),
raw_flights as (
  select cast(cast(l_shipdate as date) as varchar(10)) as flight_date,
    cast(l_suppkey as varchar(10)) as airline_id,
    cast(l_orderkey as varchar(10)) as flight_num,
    n1.n_name as origin, n2.n_name as dest,
    case when dm=0 then '2400'
         else lpad(cast(cast(floor(dm/60) as int) as varchar(2)),2,'0')
              ||lpad(cast(dm%60 as varchar(2)),2,'0') end as crs_dep_time,
    case when am%211=5 then '' when am%307=9 then '2575'
         else lpad(cast(cast(floor(am/60) as int) as varchar(2)),2,'0')
              ||lpad(cast(am%60 as varchar(2)),2,'0') end as crs_arr_time,
    case when l_orderkey%50=0 then ''
         else cast(cast(l_quantity-20 as int) as varchar(6))||'.00' end as dep_delay,
    case when l_orderkey%50=0 or l_orderkey%97=1 or h%13=0 then ''
         else cast(cast(l_quantity-25+(h%11) as int) as varchar(6))||'.00' end as arr_delay,
    case when l_orderkey%50=0 then '1' else '0' end as cancelled,
    case when l_orderkey%50=0 then 'A' else '"' end as cancellation_code,
    case when l_orderkey%97=1 then '1' else '0' end as diverted
  from t join customer c on o_custkey=c_custkey
  join nation n1 on n1.n_nationkey=c.c_nationkey
  join nation n2 on n2.n_nationkey=l_partkey%25),
flights as (
  select cast(flight_date as date) flight_date, cast(airline_id as bigint) airline_id,
    cast(flight_num as bigint) flight_num, origin, dest,
    {_minutes('crs_dep_time')} as dep_min,
    {_minutes('crs_arr_time')} as arr_min,
    try_cast(nullif(dep_delay,'') as double) dep_delay,
    try_cast(nullif(arr_delay,'') as double) arr_delay,
    cast(cancelled as int)<>0 cancelled, nullif(cancellation_code,'"') cancellation_code,
    cast(diverted as int)<>0 diverted
  from raw_flights),
pop as (
  select airport, count(*) as count from (
    select origin as airport from flights union all select dest as airport from flights)
  group by airport),
completed as (
  select * from flights where not cancelled and not diverted),
ready as (
  select * from completed where flight_date >= date '{TRIP_YEAR}-01-01'
    and flight_date < date '{TRIP_YEAR + 1}-01-01'
    and dep_min is not null and arr_min is not null and arr_delay is not null)
"""

SURVEY_CTE = """
with raw_survey as (
  select case when o_orderkey % 43 = 0 then '""' else n1.n_name end as origin,
    'US' as origin_country, cast(n1.n_regionkey as varchar) as origin_state_name,
    case when o_orderkey % 41 = 0 then null when o_orderkey % 47 = 0 then ''
         else n2.n_name end as dest,
    'US' as dest_country, cast(n2.n_regionkey as varchar) as dest_state_name
  from orders o join customer c on o_custkey = c_custkey
  join nation n1 on n1.n_nationkey = c.c_nationkey
  join nation n2 on n2.n_nationkey = o_orderkey % 25),
survey as (
  select * from raw_survey where origin is not null and dest is not null
    and origin <> '""' and dest <> '""' and origin <> '' and dest <> '')
"""


def _ts(d: str, m: str) -> str:
    return f"make_timestamp(year({d}), month({d}), day({d}), {m} // 60, {m} % 60, 0)"


# ---------------------------------------------------------------------------
# Parsing and filters

@register("flights_typed", FLIGHTS_CTE + """
select flight_date, airline_id, flight_num, origin, dest, dep_min, arr_min,
  dep_delay, arr_delay, cancelled, cancellation_code, diverted from flights""")
def flights_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.typed_flights(spark, sf_dir).select(
        "flight_date", "airline_id", "flight_num", "origin", "dest", "dep_min", "arr_min",
        "dep_delay", "arr_delay", "cancelled", "cancellation_code", "diverted")


@register("parse_hhmm", FLIGHTS_CTE + f"""
select distinct token, minutes from (
  select crs_dep_time as token, {_minutes('crs_dep_time')} as minutes from raw_flights
  union all
  select crs_arr_time as token, {_minutes('crs_arr_time')} as minutes from raw_flights)""")
def parse_hhmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_flights(spark, sf_dir)
    toks = (raw.select(F.col("crs_dep_time").alias("token"))
               .unionByName(raw.select(F.col("crs_arr_time").alias("token"))).distinct())
    return toks.select("token", hhmm_minutes("token").alias("minutes"))


@register("completed_flights", FLIGHTS_CTE + """
select flight_date, airline_id, flight_num, origin, dest, arr_delay from completed
where arr_delay is not null and airline_id is not null""")
def completed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = completed_with(fx.flights(spark, sf_dir), "arr_delay", "airline_id")
    return f.select("flight_date", "airline_id", "flight_num", "origin", "dest", "arr_delay")


# ---------------------------------------------------------------------------
# Popularity (Q1.1, Q3.1)

@register("airport_popularity", FLIGHTS_CTE + "select airport, count from pop")
def airport_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.airport_popularity(fx.flights(spark, sf_dir))


@register("popularity_rank", FLIGHTS_CTE + """
select airport, count, cast(rank() over (order by count desc) as bigint) as rank from pop""")
def popularity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.popularity_rank(fx.flights(spark, sf_dir))


@register("top_airports", FLIGHTS_CTE + """
select * from (select airport, count,
  cast(row_number() over (order by count desc, airport) as integer) as rank from pop)
where rank <= 10""")
def top_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.top_airports(fx.flights(spark, sf_dir), 10)


# ---------------------------------------------------------------------------
# Means and named top-k (Q1.2, Q2.x)

_AIRLINE_MEANS = """,
am as (select airline_id, avg(arr_delay) as mean_arr_delay from completed
       where arr_delay is not null and airline_id is not null group by airline_id)
"""


@register("mean_delay_by_airline", FLIGHTS_CTE + _AIRLINE_MEANS + "select * from am")
def mean_delay_by_airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.mean_delay_by_airline(fx.flights(spark, sf_dir))


@register("mean_delay_by_path", FLIGHTS_CTE + """
select origin, dest, avg(arr_delay) as mean_arr_delay from completed
where arr_delay is not null group by origin, dest""")
def mean_delay_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.mean_delay_by_path(fx.flights(spark, sf_dir))


@register("lookup_names", FLIGHTS_CTE + _AIRLINE_MEANS + """
select am.airline_id, am.mean_arr_delay, s.s_name as name
from am left join supplier s on s.s_suppkey = am.airline_id""")
def lookup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_names(q.mean_delay_by_airline(fx.flights(spark, sf_dir)),
                      fx.airline_names(spark, sf_dir), "airline_id")


@register("top_airlines", FLIGHTS_CTE + _AIRLINE_MEANS + """
select r.airline_id, r.mean_arr_delay, r.rank, s.s_name as name from (
  select *, cast(row_number() over (order by mean_arr_delay, airline_id) as integer) as rank
  from am) r left join supplier s on s.s_suppkey = r.airline_id
where r.rank <= 10""")
def top_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.top_airlines(fx.flights(spark, sf_dir), fx.airline_names(spark, sf_dir), 10)


TOP_CARRIERS_BY_ORIGIN_SQL = FLIGHTS_CTE + """
select r.origin, r.airline_id as airlineid, r.depdelay, r.rank, s.s_name as airline from (
  select *, cast(row_number() over (partition by origin order by depdelay, airline_id)
                 as integer) as rank
  from (select origin, airline_id, avg(dep_delay) as depdelay from completed
        where dep_delay is not null and airline_id is not null group by origin, airline_id)
) r left join supplier s on s.s_suppkey = r.airline_id where r.rank <= 10"""


@register("top_carriers_by_origin", TOP_CARRIERS_BY_ORIGIN_SQL)
def top_carriers_by_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.top_carriers_by_origin(fx.flights(spark, sf_dir), fx.airline_names(spark, sf_dir))


TOP_DESTS_BY_ORIGIN_SQL = FLIGHTS_CTE + """
select origin, dest as destination, depdelay, rank from (
  select *, cast(row_number() over (partition by origin order by depdelay, dest)
                 as integer) as rank
  from (select origin, dest, avg(dep_delay) as depdelay from completed
        where dep_delay is not null group by origin, dest)) where rank <= 10"""


@register("top_dests_by_origin", TOP_DESTS_BY_ORIGIN_SQL)
def top_dests_by_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.top_dests_by_origin(fx.flights(spark, sf_dir))


TOP_CARRIERS_BY_PATH_SQL = FLIGHTS_CTE + """
select r.origin, r.dest as destination, r.airline_id as airlineid, r.arrdelay, r.rank,
  s.s_name as airline from (
  select *, cast(row_number() over (partition by origin, dest order by arrdelay, airline_id)
                 as integer) as rank
  from (select origin, dest, airline_id, avg(arr_delay) as arrdelay from completed
        where arr_delay is not null and airline_id is not null
        group by origin, dest, airline_id)
) r left join supplier s on s.s_suppkey = r.airline_id where r.rank <= 10"""


@register("top_carriers_by_path", TOP_CARRIERS_BY_PATH_SQL)
def top_carriers_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.top_carriers_by_path(fx.flights(spark, sf_dir), fx.airline_names(spark, sf_dir))


# ---------------------------------------------------------------------------
# Weekdays and two-leg trips (QDOW, Q3.2)

@register("weekday_delay", FLIGHTS_CTE + """
select day_of_week, mean_arr_delay,
  cast(row_number() over (order by mean_arr_delay, day_of_week) as integer) as rank
from (select dayname(flight_date) as day_of_week, avg(arr_delay) as mean_arr_delay
      from ready group by 1)""")
def weekday_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.weekday_delay(fx.flights(spark, sf_dir), TRIP_YEAR)


_LEG = ("flight_date", "origin", "dest", "airline_id", "flight_num",
        "dep_min", "arr_min", "arr_delay")
_PAIRS = (FLIGHTS_CTE + """,
a as (select * from ready where dep_min < 720),
b as (select * from ready where dep_min > 720),
p as (select """ + ", ".join([f"a.{c} as {c}1" for c in _LEG] + [f"b.{c} as {c}2" for c in _LEG])
          + """, a.arr_delay + b.arr_delay as total_delay
      from a join b on a.dest = b.origin and a.flight_date = b.flight_date - 2)
""")


@register("two_leg_pairs", _PAIRS + "select * from p")
def two_leg_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.leg_pairs(fx.flights(spark, sf_dir), TRIP_YEAR)


TWO_LEG_BEST_SQL = _PAIRS + f""",
r as (select *, row_number() over (
        partition by flight_date1, origin1, dest1, dest2
        order by total_delay, arr_delay1, dep_min1, arr_min1, airline_id1, flight_num1,
                 arr_delay2, dep_min2, arr_min2, airline_id2, flight_num2) as rn from p)
select flight_date1 as start_date, strftime(flight_date1, '%d/%m/%Y') as startdate,
  origin1, dest1, dest2, flight_num1 as flightnum1, airline_id1 as airlineid1,
  {_ts('flight_date1', 'dep_min1')} as departure1,
  {_ts('flight_date1', 'arr_min1')} as arrival1,
  arr_delay1 as arrdelay1, flight_num2 as flightnum2, airline_id2 as airlineid2, origin2,
  {_ts('flight_date2', 'dep_min2')} as departure2,
  {_ts('flight_date2', 'arr_min2')} as arrival2,
  arr_delay2 as arrdelay2, total_delay
from r where rn = 1"""


@register("two_leg_best", TWO_LEG_BEST_SQL)
def two_leg_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.best_trips(fx.flights(spark, sf_dir), TRIP_YEAR)


# ---------------------------------------------------------------------------
# Ticket survey (QOD) and word counts (QWC)

@register("od_clean", SURVEY_CTE + "select * from survey")
def od_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.survey_clean(fx.raw_survey(spark, sf_dir))


@register("od_top", SURVEY_CTE + """
select * from (select airport, count,
  cast(row_number() over (order by count desc, airport) as integer) as rank
  from (select airport, count(*) as count from (
          select origin as airport from survey union all select dest from survey)
        group by airport)) where rank <= 10""")
def od_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.survey_top(fx.raw_survey(spark, sf_dir), 10)


@register("wordcount", """
select word, count(*) as count from (
  select unnest(string_split(text, ' ')) as word from documents) group by word""")
def wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wordcount(fx.spread(fx.table(spark, sf_dir, "documents").select("text")), "text", " ")


# streaming, message, lookup and source queries register themselves on import
from skyroute.plans import source_catalog, stream_catalog  # noqa: E402,F401
