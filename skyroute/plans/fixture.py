"""Flight-shaped views over the driver's TPC-H-style tables.

Mapping (our own, see FIXTURES.md): ship date = flight date, supplier =
carrier, customer nation = origin, nation (partkey mod 25) = destination.
``raw_flights`` yields the *strings* a filtered on-time CSV would hold, so the
package's own parser (``operators.flights.parse_flights``) does the typing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import os

from skyroute.operators.flights import accepted, parse_flights
from skyroute.session import scratch_path, small_methods
from skyroute.sources.csv import read_stored_flights, store_flights


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scan of fewer files than there are cores, dealt to all cores before the work on it; others unchanged.

    A file of one row group is one task however much is done with its rows. ``keys`` are those of a join that
    follows: rows dealt by them are not written and sent once more for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(*keys) if keys else df.repartition(cores)


def _hhmm(minutes: Column) -> Column:
    hh = F.lpad(F.floor(minutes / 60).cast("int").cast("string"), 2, "0")
    mm = F.lpad((minutes % 60).cast("string"), 2, "0")
    return F.concat(hh, mm)


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_methods(spark)
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"), "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    n1 = nation.select(F.col("n_nationkey").alias("_n1"), F.col("n_name").alias("origin"))
    n2 = nation.select(F.col("n_nationkey").alias("_n2"), F.col("n_name").alias("dest"))

    h = F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101 + F.col("l_partkey")
    base = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .withColumn("h", h)
              .withColumn("dm", F.col("h") % 1440)
              .withColumn("am", (F.col("h") * 7 + F.col("l_suppkey")) % 1440)
              .join(cust, F.col("o_custkey") == F.col("c_custkey"))
              .join(n1, F.col("c_nationkey") == F.col("_n1"))
              .join(n2, (F.col("l_partkey") % 25) == F.col("_n2")))
    cancelled = F.col("l_orderkey") % 50 == 0
    diverted = F.col("l_orderkey") % 97 == 1
    whole = lambda c: F.concat(c.cast("int").cast("string"), F.lit(".00"))
    return base.select(
        F.col("l_shipdate").cast("date").cast("string").alias("flight_date"),
        F.col("l_suppkey").cast("string").alias("airline_id"),
        F.col("l_orderkey").cast("string").alias("flight_num"),
        "origin", "dest",
        F.when(F.col("dm") == 0, F.lit("2400")).otherwise(_hhmm(F.col("dm"))).alias("crs_dep_time"),
        F.when(F.col("am") % 211 == 5, F.lit(""))
         .when(F.col("am") % 307 == 9, F.lit("2575"))
         .otherwise(_hhmm(F.col("am"))).alias("crs_arr_time"),
        F.when(cancelled, F.lit("")).otherwise(whole(F.col("l_quantity") - 20)).alias("dep_delay"),
        F.when(cancelled | diverted | (F.col("h") % 13 == 0), F.lit(""))
         .otherwise(whole(F.col("l_quantity") - 25 + F.col("h") % 11)).alias("arr_delay"),
        F.when(cancelled, F.lit("1")).otherwise(F.lit("0")).alias("cancelled"),
        F.when(cancelled, F.lit("A")).otherwise(F.lit('"')).alias("cancellation_code"),
        F.when(diverted, F.lit("1")).otherwise(F.lit("0")).alias("diverted"),
    )


def typed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, accepted flights parsed by our own parser (not stored)."""
    return accepted(parse_flights(raw_flights(spark, sf_dir)))


def ingest_flights(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The ingest step: parse once, store typed flights as Parquet.

    Accepted and rejected rows go to ``status=ok`` / ``status=rejected``
    partitions of one write (no filter over the parse, so nothing is
    re-evaluated and the input is read once), then by ``year``.
    """
    store_flights(parse_flights(raw_flights(spark, sf_dir)), path)


_STORED: dict = {}


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flights as the questions read them: the stored result of
    ``ingest_flights``, written once per session and input folder under the
    shared checkpoint location (the reference also loads once and queries
    the stored, filtered data).

    Reading the stored table cuts the lineage of the string building and
    parsing: otherwise Catalyst inlines those expressions into every pushed
    filter and the fused stage outgrows the 64 KB method limit.
    The table carries a ``year`` partition column used for pruning.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    path = _STORED.get(key)
    if path is None:
        path = scratch_path(spark, "flights")
        ingest_flights(spark, sf_dir, path)
        _STORED[key] = path
    return read_stored_flights(spark, path)


def airline_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier lookup (code text, description) from ``supplier``."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("description"))


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket-survey rows (6 kept string columns) from orders x customer.

    origin = the customer's nation, dest = nation (orderkey mod 25); some keys
    are null, empty or a bare quote pair so the clean-up has work to do.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    n1 = nation.select(F.col("n_nationkey").alias("_n1"), F.col("n_name").alias("_o"),
                       F.col("n_regionkey").alias("_or"))
    n2 = nation.select(F.col("n_nationkey").alias("_n2"), F.col("n_name").alias("_d"),
                       F.col("n_regionkey").alias("_dr"))
    k = F.col("o_orderkey")
    j = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
               .join(n1, F.col("c_nationkey") == F.col("_n1"))
               .join(n2, (k % 25) == F.col("_n2")))
    return j.select(
        F.when(k % 43 == 0, F.lit('""')).otherwise(F.col("_o")).alias("origin"),
        F.lit("US").alias("origin_country"),
        F.col("_or").cast("string").alias("origin_state_name"),
        F.when(k % 41 == 0, F.lit(None).cast("string"))
         .when(k % 47 == 0, F.lit("")).otherwise(F.col("_d")).alias("dest"),
        F.lit("US").alias("dest_country"),
        F.col("_dr").cast("string").alias("dest_state_name"),
    )
