"""The analytic questions, each a function of a typed flights DataFrame.

Q1.1 top_airports           top-k airports by flights from + to
Q1.2 top_airlines           top-k airlines by mean arrival delay (named)
Q2.1 top_carriers_by_origin per origin, top-k carriers by mean departure delay
Q2.2 top_dests_by_origin    per origin, top-k destinations by mean departure delay
Q2.3 top_carriers_by_path   per (origin, dest), top-k carriers by mean arrival delay
Q3.1 popularity_rank        every airport ranked by flights, ties share a rank
Q3.2 best_trips             best two-leg trip per (start date, X, Y, Z)
QDOW weekday_delay          weekdays ranked by mean arrival delay
QOD  survey_top             top-k airports in the ticket survey
QWC  word counts            operators.aggregate.wordcount
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyroute.functions.timefmt import weekday_name
from skyroute.operators.aggregate import mean_by, popularity
from skyroute.operators.flights import completed_with, drop_empty_keys, trip_ready
from skyroute.operators.lookup import with_names
from skyroute.operators.ranking import rank_with_ties, top_k, top_k_by
from skyroute.operators import trips as _trips


def airport_popularity(flights: DataFrame) -> DataFrame:
    """Flights from + to each airport; cancelled and diverted flights count too."""
    return popularity(flights, ("origin", "dest"), key="airport", count="count")


def popularity_rank(flights: DataFrame) -> DataFrame:
    """All airports with competition ranks (1, 2, 2, 4) by count, highest first."""
    return rank_with_ties(airport_popularity(flights), "count", rank="rank")


def top_airports(flights: DataFrame, k: int = 10) -> DataFrame:
    return top_k(airport_popularity(flights), [("count", "desc"), "airport"], k)


def mean_delay_by_airline(flights: DataFrame) -> DataFrame:
    f = completed_with(flights, "arr_delay", "airline_id")
    return mean_by(f, "airline_id", "arr_delay", "mean_arr_delay")


def mean_delay_by_path(flights: DataFrame) -> DataFrame:
    f = completed_with(flights, "arr_delay")
    return mean_by(f, ["origin", "dest"], "arr_delay", "mean_arr_delay")


def top_airlines(flights: DataFrame, names: DataFrame | None = None, k: int = 10) -> DataFrame:
    best = top_k(mean_delay_by_airline(flights), ["mean_arr_delay", "airline_id"], k)
    return with_names(best, names, "airline_id") if names is not None else best


def top_carriers_by_origin(flights: DataFrame, names: DataFrame | None = None,
                           k: int = 10) -> DataFrame:
    f = completed_with(flights, "dep_delay", "airline_id")
    means = mean_by(f, ["origin", "airline_id"], "dep_delay", "depdelay")
    top = top_k_by(means, "origin", ["depdelay", "airline_id"], k)
    out = top.select("origin", F.col("airline_id").alias("airlineid"), "depdelay", "rank")
    if names is not None:
        out = with_names(out, names, "airlineid", out="airline")
    return out


def top_dests_by_origin(flights: DataFrame, k: int = 10) -> DataFrame:
    f = completed_with(flights, "dep_delay")
    means = mean_by(f, ["origin", "dest"], "dep_delay", "depdelay")
    top = top_k_by(means, "origin", ["depdelay", "dest"], k)
    return top.select("origin", F.col("dest").alias("destination"), "depdelay", "rank")


def top_carriers_by_path(flights: DataFrame, names: DataFrame | None = None,
                         k: int = 10) -> DataFrame:
    f = completed_with(flights, "arr_delay", "airline_id")
    means = mean_by(f, ["origin", "dest", "airline_id"], "arr_delay", "arrdelay")
    top = top_k_by(means, ["origin", "dest"], ["arrdelay", "airline_id"], k)
    out = top.select("origin", F.col("dest").alias("destination"),
                     F.col("airline_id").alias("airlineid"), "arrdelay", "rank")
    if names is not None:
        out = with_names(out, names, "airlineid", out="airline")
    return out


def weekday_delay(flights: DataFrame, year: int) -> DataFrame:
    """Mean arrival delay per weekday in ``year``, ranked best first."""
    f = trip_ready(flights, year)
    # group on the weekday number (no per-row string formatting); each of the
    # seven groups is named once, from any of its dates, after the aggregate
    means = (f.groupBy(F.dayofweek("flight_date").alias("_dow"))
              .agg(F.avg("arr_delay").alias("mean_arr_delay"),
                   F.min("flight_date").alias("_any_date"))
              .select(weekday_name("_any_date").alias("day_of_week"), "mean_arr_delay"))
    # seven rows at most after the aggregate: an unpartitioned window is bounded
    return means.withColumn(
        "rank", F.row_number().over(Window.orderBy("mean_arr_delay", "day_of_week")))


def best_trips(flights: DataFrame, year: int, gap_days: int = 2) -> DataFrame:
    return _trips.best_trips(flights, year, gap_days)


def leg_pairs(flights: DataFrame, year: int, gap_days: int = 2) -> DataFrame:
    return _trips.leg_pairs(flights, year, gap_days)


def survey_clean(survey: DataFrame) -> DataFrame:
    return drop_empty_keys(survey, "origin", "dest")


def survey_top(survey: DataFrame, k: int = 10) -> DataFrame:
    return top_k(popularity(survey_clean(survey), ("origin", "dest"), "airport", "count"),
                 [("count", "desc"), "airport"], k)
