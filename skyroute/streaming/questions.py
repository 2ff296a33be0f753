"""The streaming form of the ranked questions, with the schemas and keys of the batch form.

Global rankings (Q1.1, Q1.2) are rebuilt from a bounded aggregate (one row per airport or
airline) and written as versions of a snapshot; per-origin rankings (Q2.1-Q2.3) are kept
up to date for the touched origins, in a keyed table split by origin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyroute.operators.aggregate import popularity
from skyroute.operators.lookup import with_names
from skyroute.operators.ranking import top_k, top_k_by
from skyroute.sources.keyed import KeyedTable
from skyroute.streaming import running as R

#: question -> (aggregate keys, metric, their published names, name of the mean, group, name of the airline)
_RANKED = {
    "carriers-by-origin": (["origin", "airline_id"], "dep_delay", ["origin", "airlineid"], "depdelay", ["origin"]),
    "dests-by-origin": (["origin", "dest"], "dep_delay", ["origin", "destination"], "depdelay", ["origin"]),
    "carriers-by-path": (["origin", "dest", "airline_id"], "arr_delay", ["origin", "destination", "airlineid"],
                         "arrdelay", ["origin", "destination"]),
}
STREAMED = ("top-airports", "top-airlines", *_RANKED)


def stream_question(question: str, flights: DataFrame, names: DataFrame | None, out: str, checkpoint: str,
                    k: int = 10, trigger: str | None = "available_now") -> StreamingQuery:
    """Start the streaming form of a question over a stream of typed flights."""
    if question == "top-airports":
        agg = popularity(flights, ("origin", "dest"), "airport", "count")
        return R.snapshot(agg, lambda b: top_k(b, [("count", "desc"), "airport"], k), out, checkpoint, trigger=trigger)
    done = flights.filter(~F.col("cancelled") & ~F.col("diverted"))
    if question == "top-airlines":
        agg = R.running_sum_count(done.filter(F.col("airline_id").isNotNull()), ["airline_id"], "arr_delay")

        def best(b: DataFrame) -> DataFrame:
            means = b.select("airline_id", (F.col("total") / F.col("n")).alias("mean_arr_delay"))
            top = top_k(means, ["mean_arr_delay", "airline_id"], k)
            return with_names(top, names, "airline_id") if names is not None else top
        return R.snapshot(agg, best, out, checkpoint, trigger=trigger)
    keys, metric, published, mean, group = _RANKED[question]
    if "airline_id" in keys:
        done = done.filter(F.col("airline_id").isNotNull())

    def ranked(b: DataFrame) -> DataFrame:
        means = b.select(*[F.col(a).alias(p) for a, p in zip(keys, published, strict=True)],
                         (F.col("total") / F.col("n")).alias(mean))
        top = top_k_by(means, group, [mean, *published[len(group):]], k)
        named = names is not None and "airlineid" in published
        return with_names(top, names, "airlineid", out="airline") if named else top
    return R.incremental_ranked(R.running_sum_count(done, keys, metric), "origin", keys, ranked, out + "_means", out,
                                checkpoint, trigger=trigger)


def read_answer(spark: SparkSession, question: str, out: str) -> DataFrame:
    """The table that ``stream_question`` keeps up to date."""
    return KeyedTable.open(spark, out).read() if question in _RANKED else R.read_snapshot(spark, out)
