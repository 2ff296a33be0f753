"""Typing and row filters of flight records (parse, rejects, completed flights)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.parse import (
    flag, hhmm_minutes, lenient_double, null_if_lone_quote, parse_date, parse_long,
)
from skyroute.functions.timefmt import year_filter
from skyroute.sources.records import MALFORMED, RAW_LINE

REJECT = "reject_reason"

# mandatory raw field -> parser; a bad value sends the row to the rejects
_MANDATORY = (
    ("flight_date", parse_date),
    ("airline_id", parse_long),
    ("flight_num", parse_long),
    ("cancelled", flag),
    ("diverted", flag),
)
_TEXT = ("origin", "origin_city_name", "origin_state_name",
         "dest", "dest_city_name", "dest_state_name")
_DOUBLES = ("dep_delay", "arr_delay", "crs_elapsed_time",
            "actual_elapsed_time", "air_time", "distance")


def parse_flights(raw: DataFrame) -> DataFrame:
    """Raw string columns (snake-case names) -> typed flights plus ``reject_reason``.

    Works with any subset of the 20 kept columns. Optional fields that do not
    parse become null; a mandatory field that does not parse (date, airline
    id, flight number, the two flags) names itself in ``reject_reason``
    (null when the row is good). A malformed line (``sources.records``) has its
    fault as the reason, and rejected rows keep their line in ``raw_line``.
    One pass, no shuffle.
    """
    have = set(raw.columns)
    cols = []
    reasons, bad = [], []
    for name, fn in _MANDATORY:
        if name in have:
            typed = fn(name)
            cols.append(typed.alias(name))
            bad.append(typed.isNull())
            reasons.append(F.when(typed.isNull(), F.lit(name)))
    for name in _TEXT:
        if name in have:
            cols.append(F.col(name))
    if "crs_dep_time" in have:
        cols.append(hhmm_minutes("crs_dep_time").alias("dep_min"))
    if "crs_arr_time" in have:
        cols.append(hhmm_minutes("crs_arr_time").alias("arr_min"))
    for name in _DOUBLES:
        if name in have:
            cols.append(lenient_double(name).alias(name))
    if "cancellation_code" in have:
        cols.append(null_if_lone_quote("cancellation_code").alias("cancellation_code"))
    # the names are put together for bad rows only
    reason = F.when(reduce(or_, bad), F.concat_ws(",", *reasons)) if bad else F.lit(None).cast("string")
    if MALFORMED in have:
        # fields of a malformed line are not to be believed, nor what is wrong with them
        reason = F.coalesce(F.col(MALFORMED), reason)
    if RAW_LINE in have:
        cols.append(F.when(reason.isNotNull(), F.col(RAW_LINE)).alias(RAW_LINE))
    return raw.select(*cols, reason.alias(REJECT))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECT).isNull()).drop(REJECT, RAW_LINE)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECT).isNotNull())


def drop_header_lines(raw: DataFrame, a: str, b: str) -> DataFrame:
    """Drop header lines repeated inside the data: both fields equal their own name."""
    return raw.filter(~((F.col(a) == F.lit(_header_name(a))) & (F.col(b) == F.lit(_header_name(b))))
                      | F.col(a).isNull() | F.col(b).isNull())


def _header_name(snake: str) -> str:
    from skyroute.schemas import RAW_NAMES, SURVEY_RAW_NAMES
    for table in (RAW_NAMES, SURVEY_RAW_NAMES):
        for orig, s in table.items():
            if s == snake:
                return orig
    return snake


def drop_empty_keys(df: DataFrame, *cols: str) -> DataFrame:
    """Survey clean-up: drop rows whose key is null, empty or a bare quote pair."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c) != F.lit('""')) & (F.col(c) != F.lit(""))
    return df.filter(cond)


def completed(df: DataFrame) -> DataFrame:
    """Flights that were neither cancelled nor diverted (null flags drop)."""
    return df.filter(~F.col("cancelled") & ~F.col("diverted"))


def completed_with(df: DataFrame, *metrics: str) -> DataFrame:
    """Completed flights whose metric columns are all present."""
    cond = ~F.col("cancelled") & ~F.col("diverted")
    for m in metrics:
        cond = cond & F.col(m).isNotNull()
    return df.filter(cond)


def trip_ready(df: DataFrame, year: int) -> DataFrame:
    """Completed, arrival delay known, both scheduled times known, in the year."""
    return year_filter(df, "flight_date", year).filter(
        ~F.col("cancelled") & ~F.col("diverted")
        & F.col("dep_min").isNotNull() & F.col("arr_min").isNotNull()
        & F.col("arr_delay").isNotNull())
