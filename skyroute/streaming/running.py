"""Running (stateful) aggregates and their published tables.

State lives in Spark's checkpointed state store, so a lost executor or a
restarted driver resumes from the last committed micro-batch. Sinks are
``foreachBatch`` writers that are idempotent per batch id (a replayed batch
rewrites the same folder), so the end-to-end result is exactly-once.

Two sink shapes:
* changelog (update mode): each micro-batch writes only the keys it changed
  into ``batch_id=<id>``; ``current()`` reads the newest row per key. Cost
  per batch follows the batch, not the number of keys.
* snapshot (complete mode): each micro-batch recomputes a ranked table from
  the full aggregate and overwrites it. Used where a derived result (top-k of
  a group) needs all of the group's keys; the aggregate has one row per key,
  bounded by the key domain (airports x carriers), not by the flight count.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyroute.session import state_off_heap
from skyroute.sources.keyed import DEFAULT_BUCKETS, KeyedTable, bucket_of
from skyroute.sources.versions import current_version, point_to, remove

BATCH = "batch_id"


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def trigger_kw(trigger: str | None) -> dict:
    """'available_now' (tests, catch-up), '<n> seconds' (fixed micro-batches), or once."""
    if trigger in (None, "available_now"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def write_batch(df: DataFrame, path: str, batch_id: int, partition_cols: Sequence[str] = (),
                files: int | None = None) -> None:
    """Idempotent per-batch write: replaces only this batch's folder (``files``: into so many files at most,
    for results that are small by their nature)."""
    out = df.withColumn(BATCH, F.lit(batch_id).cast("long"))
    out = out.coalesce(files) if files else out
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH, *partition_cols).parquet(path))


def newest_per_key(log: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows of the newest ``batch_id`` of every key (partial max per key, then
    a semi-join: no key is gathered whole)."""
    keys = _keys(keys)
    newest = log.groupBy(*keys).agg(F.max(BATCH).alias("_newest"))
    cond = [log[k].eqNullSafe(newest[k]) for k in keys] + [log[BATCH] == newest["_newest"]]
    return log.join(newest, cond, "left_semi")


def _base(spark: SparkSession, base_root: str, upto: int) -> DataFrame:
    return spark.read.parquet(f"{base_root}/upto={upto}").withColumn(BATCH, F.lit(upto).cast("long"))


def current(spark: SparkSession, path: str, keys: Sequence[str] | str,
            base_root: str | None = None) -> DataFrame:
    """Newest version of every key in a changelog table.

    With compaction (``base_root``), only the base that the pointer names and
    the log partitions after it are read (a static filter on ``batch_id``).
    """
    log = spark.read.parquet(path)
    upto = current_version(spark, base_root)
    if upto is not None:
        log = _base(spark, base_root, upto).unionByName(log.filter(F.col(BATCH) > F.lit(upto)))
    return newest_per_key(log, keys).drop(BATCH)


def compact(spark: SparkSession, path: str, keys: Sequence[str] | str, base_root: str,
            upto: int) -> None:
    """Write the newest row per key as of batch ``upto`` to ``base_root/upto=<id>``, then point to it.

    Rewriting the same ``upto`` after a failure is idempotent: it starts from an
    older base.
    """
    log = spark.read.parquet(path).filter(F.col(BATCH) <= F.lit(upto))
    prev = current_version(spark, base_root)
    if prev is not None and prev >= upto:
        return
    if prev is not None:
        log = _base(spark, base_root, prev).unionByName(log.filter(F.col(BATCH) > F.lit(prev)))
    newest_per_key(log, keys).drop(BATCH).write.mode("overwrite").parquet(f"{base_root}/upto={upto}")
    point_to(spark, base_root, upto)


def start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
          mode: str = "update", trigger: str | None = "available_now",
          name: str | None = None) -> StreamingQuery:
    state_off_heap(df.sparkSession)
    w = (df.writeStream.outputMode(mode).foreachBatch(sink)
           .option("checkpointLocation", checkpoint).trigger(**trigger_kw(trigger)))
    if name:
        w = w.queryName(name)
    return w.start()


def run(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for an available-now query; always stop it (also on interrupt)."""
    try:
        query.awaitTermination(timeout)
        if query.exception():
            raise query.exception()
    finally:
        stop_gracefully(query)


def drain(streams: Sequence[DataFrame], build: Callable[[DataFrame], StreamingQuery]) -> None:
    """Run ``build`` (one output, one checkpoint) over each input batch in turn."""
    for s in streams:
        run(build(s))


def stop_gracefully(query: StreamingQuery) -> None:
    """Stop after the micro-batch in flight is done and committed."""
    last = (query.lastProgress or {}).get("batchId")
    while query.isActive and query.status["isTriggerActive"] \
            and (query.lastProgress or {}).get("batchId") == last:
        time.sleep(0.1)
    if query.isActive:
        query.stop()


# -- running counts (word count, popularity) --------------------------------

def running_counts(stream: DataFrame, keys: Sequence[str] | str, out_path: str, checkpoint: str,
                   count: str = "count", trigger: str | None = "available_now",
                   base_root: str | None = None, compact_every: int | None = None,
                   seed: DataFrame | None = None) -> StreamingQuery:
    """Count per key over the whole stream; changed keys appended per batch.

    ``seed`` (keys, ``count``) are counts to start from: the first batch writes
    all of its keys, and every later row holds its key's seed as well.

    With ``base_root`` and ``compact_every``, every n-th batch also writes a
    compacted base so that ``current(..., base_root=...)`` reads stay bounded.
    """
    agg = stream.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(count))

    def sink(b: DataFrame, i: int) -> None:
        write_batch(b if seed is None else seeded(b, seed, keys, count, "full_outer" if i == 0 else "left"), out_path, i)
        if base_root and compact_every and (i + 1) % compact_every == 0:
            compact(b.sparkSession, out_path, keys, base_root, i)
    return start(agg, sink, checkpoint, "update", trigger)


def seeded(counts: DataFrame, seed: DataFrame, keys: Sequence[str] | str,
           count: str = "count", how: str = "full_outer") -> DataFrame:
    """Counts with an initial state: seed + occurrences; with a full join seed-only keys appear too."""
    keys = _keys(keys)
    s = seed.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(count).alias("_seed"))
    j = counts.join(s, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], how)
    return j.select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], (F.coalesce(F.col(count), F.lit(0))
                            + F.coalesce(F.col("_seed"), F.lit(0))).cast("long").alias(count))


# -- per-batch (stateless) aggregate -----------------------------------------

def per_batch(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], out_path: str,
              checkpoint: str, trigger: str | None = "available_now", files: int | None = None) -> StreamingQuery:
    """Apply a batch transformation to each micro-batch on its own (no state)."""
    return start(stream, lambda b, i: write_batch(fn(b), out_path, i, files=files), checkpoint, "append", trigger)


# -- running means and their ranked snapshots -------------------------------

def running_sum_count(stream: DataFrame, keys: Sequence[str] | str, metric: str) -> DataFrame:
    """Streaming (total, n) per key: two numbers of state per key."""
    return (stream.filter(F.col(metric).isNotNull()).groupBy(*_keys(keys))
                  .agg(F.sum(metric).alias("total"), F.count(F.lit(1)).alias("n")))


def snapshot(agg: DataFrame, derive: Callable[[DataFrame], DataFrame], out_path: str,
             checkpoint: str, partition_cols: Sequence[str] = (),
             trigger: str | None = "available_now") -> StreamingQuery:
    """Complete-mode aggregate -> derived table, one new version per micro-batch.

    Each batch writes ``version=<batch id>`` (a replay rewrites its own
    version) and points to it last, so readers of ``read_snapshot`` never see a
    half-written table. Of the older versions the previous one stays, for those
    who still read it.
    """
    def sink(b: DataFrame, i: int) -> None:
        out = derive(b).write.mode("overwrite")
        (out.partitionBy(*partition_cols) if partition_cols else out).parquet(f"{out_path}/{VERSION}={i}")
        point_to(b.sparkSession, out_path, i)
        remove(b.sparkSession, f"{out_path}/{VERSION}={i - 2}")
    return start(agg, sink, checkpoint, "complete", trigger)


VERSION = "version"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The version that the pointer names; no other folder is listed."""
    return spark.read.parquet(f"{path}/{VERSION}={current_version(spark, path)}")


# -- incremental per-group rankings -------------------------------------------

def incremental_ranked(agg: DataFrame, part_col: str, keys: Sequence[str],
                       derive: Callable[[DataFrame], DataFrame], state_path: str,
                       out_path: str, checkpoint: str,
                       trigger: str | None = "available_now", buckets: int = DEFAULT_BUCKETS) -> StreamingQuery:
    """Per-group ranked table kept up to date for the touched groups only.

    ``agg`` is a streaming aggregate run in update mode, so each micro-batch
    holds only the keys it changed, with their running values. They are
    upserted into a keyed table of all aggregate rows that is split into
    hash buckets of ``part_col`` (e.g. origin); only the buckets of the
    touched groups are opened (static folder names). ``derive`` then ranks the
    rows of those buckets, which become the buckets' new contents in the keyed
    table at ``out_path``. Per-batch cost follows the touched buckets, not the
    number of keys, and readers of either table see whole batches only. A
    replayed batch puts the same running values in again.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()
        try:
            spark = changed.sparkSession
            if changed.isEmpty():
                return
            # null is a group of its own, as in the batch form
            part = bucket_of([part_col], buckets)
            state = KeyedTable(spark, state_path, changed.schema, keys, part)
            touched = state.upsert(changed)
            ranked = derive(state.read(touched))
            KeyedTable(spark, out_path, ranked.schema, [part_col], part).replace(ranked, touched)
        finally:
            changed.unpersist()

    return start(agg, sink, checkpoint, "update", trigger)
