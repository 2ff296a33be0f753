"""Rebuild a published table from a stream's checkpointed state.

The state store holds every key's running value; the published changelog or table is only a copy of
it. If the copy is lost or damaged, the state data source reads the checkpoint as a DataFrame, as
partitioned as the state is, and the table is written anew; neither the input nor its history is read.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.sources.versions import child_names
from skyroute.streaming.running import write_batch


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that the checkpoint has committed."""
    done = [int(n) for n in child_names(spark, os.path.join(checkpoint, "commits")) if n.isdigit()]
    if not done:
        raise FileNotFoundError(f"no committed batch in {checkpoint}")
    return max(done)


def state_rows(spark: SparkSession, checkpoint: str, keys: Sequence[str], values: Sequence[str],
               batch: int | None = None, operator: int = 0) -> DataFrame:
    """(keys, values) of a streaming aggregate's state after ``batch`` (the last committed one by default).

    State columns are matched by position: grouping keys first, then aggregates, in the order of the query.
    """
    at = last_batch(spark, checkpoint) if batch is None else batch
    state = (spark.read.format("statestore").option("batchId", at).option("operatorId", operator).load(checkpoint))
    k, v = state.schema["key"].dataType.names, state.schema["value"].dataType.names
    return state.select(*[F.col(f"key.`{c}`").alias(n) for c, n in zip(k, keys, strict=True)],
                        *[F.col(f"value.`{c}`").alias(n) for c, n in zip(v, values, strict=True)])


def rebuild(rows: DataFrame, out_path: str, spark: SparkSession, checkpoint: str) -> int:
    """Write a changelog table that holds all ``rows`` as of the last committed batch, so that the stream can
    go on into it; that batch's number."""
    at = last_batch(spark, checkpoint)
    write_batch(rows, out_path, at)
    return at
