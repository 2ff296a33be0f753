"""Replay the driver tables as streams: split into ordered input batches.

Every row lands in exactly one batch; the union of the batches is the whole
table. Folders live under the session's shared checkpoint location.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.operators.flights import accepted, parse_flights
from skyroute.plans import fixture as fx
from skyroute.session import scratch_path
from skyroute.sources.messages import (
    DEFAULT_CHUNK, as_kept_layout, flights_from_lines, lines_from_messages, to_csv_lines,
    to_messages, with_positions,
)
from skyroute.streaming.sources import batch_streams, split_to_batches

N_BATCHES = 5

_PUBLISHED: dict = {}


def _published(spark: SparkSession, key: tuple, publish) -> str:
    """Input batches are published once per session (as a producer would) and
    every consuming stream reads them from the start with its own checkpoint."""
    k = (spark.sparkContext.applicationId, os.path.abspath(key[1])) + key[:1] + key[2:]
    if k not in _PUBLISHED:
        path = scratch_path(spark, key[0] + "-batches")
        publish(path)
        _PUBLISHED[k] = path
    return _PUBLISHED[k]


def flight_line_streams(spark: SparkSession, sf_dir: str, n: int = N_BATCHES,
                        lines_per_message: int = DEFAULT_CHUNK) -> list[DataFrame]:
    """Raw flights rendered as CSV lines, packed into chunked messages (as a
    producer publishes them) and written in ``n`` batches; read back as
    streams of typed flights: message -> lines -> CSV fields -> parser."""
    def publish(path: str) -> None:
        lines = to_csv_lines(as_kept_layout(fx.raw_flights(spark, sf_dir)), "line")
        placed = with_positions(lines, scratch_path(spark, "flight-lines"))
        msgs = to_messages(placed, lines_per_message).select("value")
        split_to_batches(msgs, path, F.pmod(F.crc32(F.col("value")), F.lit(n)))
    path = _published(spark, ("flights", sf_dir, n, lines_per_message), publish)
    return [accepted(parse_flights(flights_from_lines(lines_from_messages(s))))
            for s in batch_streams(spark, path, n, "value string, batch int")]


def document_streams(spark: SparkSession, sf_dir: str, n: int = N_BATCHES) -> list[DataFrame]:
    """``documents`` in ``n`` batches (doc_id mod n; rows without an id are in the first)."""
    def publish(path: str) -> None:
        docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
        split_to_batches(docs, path, F.coalesce(F.pmod(F.col("doc_id"), F.lit(n)), F.lit(0)))
    path = _published(spark, ("documents", sf_dir, n), publish)
    return batch_streams(spark, path, n, "doc_id long, text string, batch int")
