"""Stream lifecycle: stop after the batch that carries an end marker."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyroute.streaming.running import trigger_kw

_STOPPED = "stopped after the marker batch"


def run_until_marker(stream: DataFrame, is_marker: Column,
                     sink: Callable[[DataFrame, int], None], checkpoint: str,
                     trigger: str | None = "available_now") -> bool:
    """Process micro-batches with ``sink``; the batch holding a row matching
    ``is_marker`` is processed in full and committed, then the query stops.
    A later batch that begins meanwhile is refused by an error, so Spark does
    not commit it and a restart takes it up again.

    Whether a batch holds a marker is observed while ``sink`` writes it, by a
    metric of the batch's rows: the source is read once. ``sink`` must run an
    action that reads the whole batch; of several, the first is observed.
    Returns whether a marker was met.
    """
    marked: list[int] = []

    def fb(b: DataFrame, i: int) -> None:
        if marked:
            raise RuntimeError(_STOPPED)
        seen = Observation()
        sink(b.observe(seen, F.max(is_marker.cast("int")).alias("marker")), i)
        if seen.get.get("marker"):
            marked.append(i)

    q = (stream.writeStream.foreachBatch(fb).option("checkpointLocation", checkpoint)
               .trigger(**trigger_kw(trigger)).start())
    try:
        while q.isActive:
            # progress of a batch is reported after its commit
            if marked and q.lastProgress and q.lastProgress["batchId"] >= marked[0]:
                break
            try:
                q.awaitTermination(0.2)
            except StreamingQueryException as e:
                if not marked or _STOPPED not in str(e):
                    raise
        if (error := q.exception()) and not (marked and _STOPPED in str(error)):
            raise error
    finally:
        q.stop()
    return bool(marked)


def drain_until_marker(streams: Sequence[DataFrame], is_marker: Column, sink: Callable[[DataFrame, int], None],
                       checkpoint: str) -> bool:
    """Run the input batches in turn (one checkpoint); those after the one with the marker are not opened."""
    return any(run_until_marker(s, is_marker, sink, checkpoint) for s in streams)
