"""Lines <-> messages: chunked message values and their parsing back to rows.

A message value holds 1..n CSV lines joined by '\n' (the producer's chunked
form); one message per line is the chunk size 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.schemas import KEPT_RAW, ONTIME_KEPT_SCHEMA
from skyroute.sources.records import records

# Fixed value: lines per message in the chunked producer.
DEFAULT_CHUNK = 5000

# writing keeps an empty string as a quoted "" so it reads back as '' (an unquoted empty field reads as null)
_CSV_WRITE = {"sep": ",", "quote": '"', "escape": '"'}


def as_kept_layout(raw: DataFrame) -> DataFrame:
    """Raw flight strings in the 20-column kept layout (missing columns empty)."""
    have = set(raw.columns)
    return raw.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c)
                        for c in KEPT_RAW])


def to_csv_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Each row rendered as one CSV line (quotes doubled)."""
    return df.select(F.to_csv(F.struct(*df.columns), _CSV_WRITE).alias(line))


def with_positions(df: DataFrame, path: str, group: str = "part", pos: str = "pos") -> DataFrame:
    """Rows with their place in the stored form of ``df``: (file, number in the file).

    The rows are written to ``path`` once, and a row's place is where it lies there, told by Parquet's
    own row numbers. So every later reading, however it is split into tasks and whichever of them run
    again, numbers a line alike; numbers given while a query runs would not be the same after a lost
    task that reads a shuffle in another order.
    """
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select("*", F.col("_metadata.file_name").alias(group), F.col("_metadata.row_index").alias(pos))


def to_messages(lines: DataFrame, chunk: int = DEFAULT_CHUNK, group_cols: Sequence[str] = ("part",),
                pos: str = "pos", line: str = "line") -> DataFrame:
    """Group consecutive lines of each group into messages of exactly ``chunk``
    lines (the last one shorter). Every message is built from at most
    ``chunk`` rows, so no group is gathered whole.
    """
    g = list(group_cols)
    chunked = lines.withColumn("chunk_no", F.floor(F.col(pos) / F.lit(chunk)).cast("long"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(line).alias("l"))))
    return (chunked.groupBy(*g, "chunk_no")
                   .agg(F.count(F.lit(1)).alias("n_lines"),
                        F.array_join(F.transform(ordered, lambda x: x["l"]), "\n").alias("value")))


def lines_from_messages(messages: DataFrame, value: str = "value", line: str = "line") -> DataFrame:
    """Message values -> one row per non-empty line (empty messages give no rows)."""
    return (messages.select(F.explode(F.split(F.col(value), "\n", -1)).alias(line))
                    .filter(F.col(line) != F.lit("")))


def flights_from_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """CSV lines in the kept layout -> raw string columns, faults and raw lines (then ``parse_flights``)."""
    return records(lines, ONTIME_KEPT_SCHEMA, line)


def write_messages_kafka(messages: DataFrame, servers: str, topic: str,
                         key: str | None = None) -> None:
    """Publish message values to a topic (gzip, acks=1, two retries).

    Needs the Kafka connector on the classpath; it is not in the test image.
    """
    cols = [F.col("value").cast("string").alias("value")]
    if key:
        cols.append(F.col(key).cast("string").alias("key"))
    (messages.select(*cols).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("kafka.compression.type", "gzip").option("kafka.acks", "1")
        .option("kafka.retries", "2").save())
