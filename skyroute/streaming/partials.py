"""Two-stage pipeline: per-micro-batch partial aggregates are stored, then
merged (as a batch read or as another stream) into the final answer.

Partials are typed Parquet (sum and count, or counts). Every attempt at a batch writes a folder of its
own; a commit file, created last and only once for each batch number, names the folder that counts:

    <path>/data/batch_id=<id>/attempt=<id>/...   partials of one attempt
    <path>/commits/<batch id>                    the folder that counts

So a replayed batch finds its commit and changes nothing, what a lost attempt left is read by nobody, and
the second stage, which follows the commit files, takes each batch exactly once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyroute.operators.aggregate import merge_means, sum_count_by
from skyroute.sources.keyed import DEFAULT_BUCKETS, KeyedTable, bucket_of
from skyroute.sources.versions import create_text, read_text
from skyroute.streaming.running import BATCH, start

_COMMIT = "batch_id long, attempt string"


def _names(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def commit_batch(df: DataFrame, path: str, batch_id: int) -> bool:
    """Store the rows of a batch, once: False, and nothing is written, if the batch is committed already."""
    spark, commit = df.sparkSession, f"{path}/commits/{batch_id:012d}"
    if read_text(spark, commit) is not None:
        return False
    attempt = uuid.uuid4().hex[:12]
    df.write.parquet(f"{path}/data/{BATCH}={batch_id}/attempt={attempt}")
    return create_text(spark, commit, json.dumps({BATCH: batch_id, "attempt": attempt}))


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches, with ``batch_id``."""
    commits = spark.read.schema(_COMMIT).json(f"{path}/commits")
    rows = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    # partition columns of figures and letters have types of their own
    rows = rows.withColumn("attempt", F.col("attempt").cast("string")).withColumn(BATCH, F.col(BATCH).cast("long"))
    return rows.join(commits, [BATCH, "attempt"], "left_semi").drop("attempt")


def stage_partials(stream: DataFrame, keys: Sequence[str] | str, metric: str | None,
                   out_path: str, checkpoint: str,
                   trigger: str | None = "available_now") -> StreamingQuery:
    """Stage 1: per micro-batch (total, n) of ``metric`` per key, or the count
    per key when ``metric`` is None."""
    keys = _names(keys)

    def partial(b: DataFrame) -> DataFrame:
        return b.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if metric is None else sum_count_by(b, keys, metric)
    return start(stream, lambda b, i: commit_batch(partial(b), out_path, i), checkpoint, "append", trigger)


def merge_partials(spark: SparkSession, path: str, keys: Sequence[str] | str,
                   name: str, metric: bool = True) -> DataFrame:
    """Stage 2: merge all committed partials into the mean (or count) per key."""
    parts = committed(spark, path)
    if metric:
        return merge_means(parts, keys, name)
    return parts.groupBy(*_names(keys)).agg(F.sum("n").alias(name))


def merge_partials_stream(spark: SparkSession, path: str, keys: Sequence[str] | str, out_path: str,
                          checkpoint: str, metric: bool = True, trigger: str | None = "available_now",
                          batches_per_trigger: int = 1000, buckets: int = DEFAULT_BUCKETS) -> StreamingQuery:
    """Stage 2 as a stream over the commit files of stage 1, which must have committed a batch.

    Each micro-batch reads the folders of at most ``batches_per_trigger`` new commits and adds their sums to a
    keyed table of running (total, n) per key, whose touched buckets alone are rewritten. The table records the
    micro-batch, so one that is replayed after its sums were added is not added again.
    """
    keys, sums = _names(keys), ["total", "n"] if metric else ["n"]
    commits = (spark.readStream.schema(_COMMIT).option("maxFilesPerTrigger", batches_per_trigger)
                    .json(f"{path}/commits"))

    def sink(new: DataFrame, batch_id: int) -> None:
        session = new.sparkSession
        folders = [f"{path}/data/{BATCH}={r[0]}/attempt={r[1]}" for r in new.collect()]
        if not folders:
            return
        added = session.read.parquet(*folders).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
        table = KeyedTable(session, out_path, added.schema, keys, bucket_of(keys, buckets))
        table.upsert(added, batch=batch_id, add=sums)
    return start(commits, sink, checkpoint, "append", trigger)


def read_merged(spark: SparkSession, out_path: str, keys: Sequence[str] | str, name: str, metric: bool = True) -> DataFrame:
    """The mean (or count) per key that the second stage keeps up to date."""
    value = F.col("total") / F.col("n") if metric else F.col("n")
    return KeyedTable.open(spark, out_path).read().select(*_names(keys), value.alias(name))
