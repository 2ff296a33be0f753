"""CSV sources and sinks of the on-time, survey and lookup data.

Reading is schema-first (all strings, never inferred), quoted commas
supported, one record per line. Flight records are read line by line, so that
malformed ones go to the rejects with their fault and their line
(``sources.records``). Typing happens in ``operators.flights``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.operators.flights import REJECT, drop_empty_keys, drop_header_lines, parse_flights
from skyroute.sources.records import MALFORMED, RAW_LINE, records
from skyroute.schemas import (
    KEPT_RAW, LOOKUP_SCHEMA, ONTIME_KEPT_SCHEMA, ONTIME_RAW_SCHEMA, SURVEY_KEPT_RAW,
    SURVEY_KEPT_SCHEMA, SURVEY_RAW_SCHEMA,
)

CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',           # quotes inside a quoted field are doubled
    "multiLine": "false",
    "emptyValue": "",        # keep an empty quoted string as ''
    "nullValue": "\u0001",   # no text stands for null (unquoted empty -> null)
    "mode": "PERMISSIVE",
}


def read_csv(spark: SparkSession, path, schema, header: bool, recursive: bool = True) -> DataFrame:
    r = spark.read.schema(schema).options(**CSV_OPTIONS).option("header", str(header).lower())
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.csv(path)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of all text files below ``path``."""
    return spark.read.option("recursiveFileLookup", "true").text(path).withColumnRenamed("value", "line")


def read_ontime_raw(spark: SparkSession, path) -> DataFrame:
    """75-column archive CSV, header lines (the first of every file) included, with faults and raw lines."""
    return records(read_lines(spark, path), ONTIME_RAW_SCHEMA)


def filter_ontime(raw: DataFrame, faults: bool = False) -> DataFrame:
    """Drop header lines, keep the 20 columns used downstream; with ``faults`` also what is wrong with a line,
    and the line, for ``parse_flights`` to reject it."""
    beside = (MALFORMED, RAW_LINE) if faults else ()
    return drop_header_lines(raw, "flight_date", "airline_id").select(*KEPT_RAW, *beside)


def read_ontime_filtered(spark: SparkSession, path) -> DataFrame:
    """20-column filtered CSV (written without a header), with faults and raw lines."""
    return records(read_lines(spark, path), ONTIME_KEPT_SCHEMA)


def read_flights_csv(spark: SparkSession, path) -> DataFrame:
    """Filtered CSV -> typed flights with ``reject_reason`` and the rejected lines."""
    return parse_flights(read_ontime_filtered(spark, path))


def read_flights_text(spark: SparkSession, path) -> DataFrame:
    """Text scan + per-line CSV parse (kept layout) -> typed flights with rejects."""
    from skyroute.sources.messages import flights_from_lines
    return parse_flights(flights_from_lines(read_lines(spark, path)))


def read_survey_raw(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, SURVEY_RAW_SCHEMA, header=True)


def filter_survey(raw: DataFrame) -> DataFrame:
    """Project to 6 columns, drop inner headers and rows with empty keys."""
    kept = drop_header_lines(raw, "origin", "dest").select(*SURVEY_KEPT_RAW)
    return drop_empty_keys(kept, "origin", "dest")


def read_survey_filtered(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, SURVEY_KEPT_SCHEMA, header=False)


def read_lookup(spark: SparkSession, path, header: bool = True) -> DataFrame:
    """Two-column (code, description) lookup CSV."""
    return read_csv(spark, path, LOOKUP_SCHEMA, header=header, recursive=False)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False,
              compression: str | None = None, max_records_per_file: int | None = None) -> None:
    """CSV sink without header; quotes doubled; nulls as empty fields."""
    w = (df.write.mode(mode).option("header", str(header).lower())
           .option("quote", '"').option("escape", '"').option("emptyValue", '""'))
    if compression:
        w = w.option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.csv(path)


def ingest_ontime(spark: SparkSession, raw_path, out_path: str) -> None:
    """Archive CSV -> typed Parquet in one pass.

    Accepted and rejected rows land in ``status=ok`` / ``status=rejected``
    partitions of the same write, so the input is scanned once. Accepted
    flights are further partitioned by year for date-range pruning.
    """
    store_flights(parse_flights(filter_ontime(read_ontime_raw(spark, raw_path), faults=True)), out_path)


def store_flights(parsed: DataFrame, out_path: str) -> None:
    """Parsed flights as Parquet by ``status`` and ``year``.

    Rows are rebalanced by the folder they go to: adaptive execution gathers small folders
    into one task and splits large ones by size, so files are of the advisory partition size
    rather than one for every task and year, and no year is written by a single task.
    """
    status = F.when(F.col(REJECT).isNull(), F.lit("ok")).otherwise(F.lit("rejected"))
    (parsed.withColumn("status", status).withColumn("year", F.year("flight_date"))
           .hint("rebalance", "status", "year")
           .write.mode("overwrite").partitionBy("status", "year").parquet(out_path))


def read_ingested(spark: SparkSession, path: str, status: str = "ok") -> DataFrame:
    df = spark.read.parquet(path).filter(F.col("status") == status).drop("status")
    return df.drop(REJECT, RAW_LINE) if status == "ok" else df


def export_table(df: DataFrame, columns, path: str) -> None:
    """Table export as CSV with a column list (header line names the columns)."""
    write_csv(df.select(*columns), path, header=True)


def import_table(spark: SparkSession, schema, path: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("header", "true").csv(path)


def read_stored_flights(spark: SparkSession, path: str) -> DataFrame:
    """Accepted flights of an ingested table (prunes to the ``status=ok`` folders)."""
    return (spark.read.parquet(path).filter(F.col("status") == F.lit("ok"))
                 .drop("status", REJECT, RAW_LINE))
