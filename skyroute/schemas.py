"""Record layouts of the on-time and ticket-survey data and of our outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: column names of the public source data formats. ---------
# On-time performance records, 75 columns, in file order.
ONTIME_RAW_COLUMNS = (
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate",
    "UniqueCarrier", "AirlineID", "Carrier", "TailNum", "FlightNum", "Origin",
    "OriginCityName", "OriginState", "OriginStateFips", "OriginStateName",
    "OriginWac", "Dest", "DestCityName", "DestState", "DestStateFips",
    "DestStateName", "DestWac", "CRSDepTime", "DepTime", "DepDelay",
    "DepDelayMinutes", "DepDel15", "DepartureDelayGroups", "DepTimeBlk",
    "TaxiOut", "WheelsOff", "WheelsOn", "TaxiIn", "CRSArrTime", "ArrTime",
    "ArrDelay", "ArrDelayMinutes", "ArrDel15", "ArrivalDelayGroups",
    "ArrTimeBlk", "Cancelled", "CancellationCode", "Diverted",
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Flights", "Distance",
    "DistanceGroup", "CarrierDelay", "WeatherDelay", "NASDelay",
    "SecurityDelay", "LateAircraftDelay", "FirstDepTime", "TotalAddGTime",
    "LongestAddGTime", "DivAirportLandings", "DivReachedDest",
    "DivActualElapsedTime", "DivArrDelay", "DivDistance",
    "Div1Airport", "Div1WheelsOn", "Div1TotalGTime", "Div1LongestGTime",
    "Div1WheelsOff", "Div1TailNum",
    "Div2Airport", "Div2WheelsOn", "Div2TotalGTime", "Div2LongestGTime",
    "Div2WheelsOff", "Div2TailNum",
)

# The 20 columns kept by ingest, in the order of the filtered files.
ONTIME_KEPT_COLUMNS = (
    "FlightDate", "AirlineID", "FlightNum", "Origin", "OriginCityName",
    "OriginStateName", "Dest", "DestCityName", "DestStateName", "CRSDepTime",
    "DepDelay", "CRSArrTime", "ArrDelay", "Cancelled", "CancellationCode",
    "Diverted", "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Distance",
)

# Ticket survey (origin and destination), 34 columns, in file order.
SURVEY_RAW_COLUMNS = (
    "ItinID", "MktID", "SeqNum", "Coupons", "Year", "Quarter", "Origin",
    "OriginAptInd", "OriginCityNum", "OriginCountry", "OriginStateFips",
    "OriginState", "OriginStateName", "OriginWac", "Dest", "DestAptInd",
    "DestCityNum", "DestCountry", "DestStateFips", "DestState",
    "DestStateName", "DestWac", "Break", "CouponType", "TkCarrier",
    "OpCarrier", "RPCarrier", "Passengers", "FareClass", "Distance",
    "DistanceGroup", "Gateway", "ItinGeoType", "CouponGeoType",
)

SURVEY_KEPT_COLUMNS = (
    "Origin", "OriginCountry", "OriginStateName", "Dest", "DestCountry",
    "DestStateName",
)
# --- end of fixed values ----------------------------------------------------


def _snake(name: str) -> str:
    out = []
    for i, ch in enumerate(name):
        prev = name[i - 1] if i else ""
        nxt = name[i + 1] if i + 1 < len(name) else ""
        if ch.isupper() and i and (prev.islower() or (nxt.islower() and prev.isupper())):
            out.append("_")
        out.append(ch.lower())
    return "".join(out)


# Raw (string) column names we use inside the library: snake case of the above.
RAW_NAMES = {c: _snake(c) for c in ONTIME_RAW_COLUMNS}
KEPT_RAW = tuple(RAW_NAMES[c] for c in ONTIME_KEPT_COLUMNS)
SURVEY_RAW_NAMES = {c: _snake(c) for c in SURVEY_RAW_COLUMNS}
SURVEY_KEPT_RAW = tuple(SURVEY_RAW_NAMES[c] for c in SURVEY_KEPT_COLUMNS)


def string_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


ONTIME_RAW_SCHEMA = string_schema(RAW_NAMES.values())
ONTIME_KEPT_SCHEMA = string_schema(KEPT_RAW)
SURVEY_RAW_SCHEMA = string_schema(SURVEY_RAW_NAMES.values())
SURVEY_KEPT_SCHEMA = string_schema(SURVEY_KEPT_RAW)

LOOKUP_SCHEMA = T.StructType([
    T.StructField("code", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
])

# Typed flight record produced by operators.flights.parse_flights.
FLIGHT_SCHEMA = T.StructType([
    T.StructField("flight_date", T.DateType(), True),
    T.StructField("airline_id", T.LongType(), True),
    T.StructField("flight_num", T.LongType(), True),
    T.StructField("origin", T.StringType(), True),
    T.StructField("origin_city_name", T.StringType(), True),
    T.StructField("origin_state_name", T.StringType(), True),
    T.StructField("dest", T.StringType(), True),
    T.StructField("dest_city_name", T.StringType(), True),
    T.StructField("dest_state_name", T.StringType(), True),
    T.StructField("dep_min", T.IntegerType(), True),
    T.StructField("dep_delay", T.DoubleType(), True),
    T.StructField("arr_min", T.IntegerType(), True),
    T.StructField("arr_delay", T.DoubleType(), True),
    T.StructField("cancelled", T.BooleanType(), True),
    T.StructField("cancellation_code", T.StringType(), True),
    T.StructField("diverted", T.BooleanType(), True),
    T.StructField("crs_elapsed_time", T.DoubleType(), True),
    T.StructField("actual_elapsed_time", T.DoubleType(), True),
    T.StructField("air_time", T.DoubleType(), True),
    T.StructField("distance", T.DoubleType(), True),
])
