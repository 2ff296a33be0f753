"""Two-leg trips over a flight stream, with the global minimum across batches.

State: the best flight per leg key (side, date, origin, dest) as a streaming
``min(struct(order..., flight...))`` aggregate, so a first leg and a second
leg that arrive in different micro-batches still meet, and a replayed batch
cannot change a minimum. Two sinks:

* ``stream_two_leg`` (complete mode): after each micro-batch the trip table
  is rebuilt from all best legs, a table bounded by the route-day domain.
  Simple; fine for small inputs.
* ``stream_two_leg_incremental`` (update mode): only the changed best legs
  are upserted into a keyed leg table split by month, and trips are recomputed
  for the touched start months only. Both tables are published whole.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyroute.operators.flights import trip_ready
from skyroute.operators.trips import LEG_COLS, LEG_ORDER, NOON, trips_from_sided
from skyroute.sources.keyed import KeyedTable, month_of
from skyroute.streaming.running import snapshot, start

_KEY = ("flight_date", "origin", "dest")
TRIP_KEY = ("start_date", "origin1", "dest1", "dest2")


def best_leg_state(flights: DataFrame, year: int) -> DataFrame:
    f = trip_ready(flights, year).withColumn(
        "side", F.when(F.col("dep_min") < NOON, F.lit(1)).when(F.col("dep_min") > NOON, F.lit(2)))
    f = f.filter(F.col("side").isNotNull())
    rest = [c for c in LEG_COLS if c not in _KEY and c not in LEG_ORDER]
    best = F.min(F.struct(*[F.col(c) for c in LEG_ORDER], *[F.col(c) for c in rest]))
    return f.groupBy("side", *_KEY).agg(best.alias("best"))


def trips_from_state(state: DataFrame, gap_days: int = 2) -> DataFrame:
    return trips_from_sided(state.select("side", *_KEY, "best.*"), gap_days)


def stream_two_leg(flights: DataFrame, year: int, out_path: str, checkpoint: str,
                   gap_days: int = 2, trigger: str | None = "available_now") -> StreamingQuery:
    return snapshot(best_leg_state(flights, year),
                    lambda b: trips_from_state(b, gap_days), out_path, checkpoint,
                    partition_cols=("origin1",), trigger=trigger)


# -- incremental form ---------------------------------------------------------

def _next_month(d):
    return (d.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)


def _months(first, last) -> list:
    """First days of all months from the month of ``first`` to that of ``last``."""
    out = [first.replace(day=1)]
    while _next_month(out[-1]) <= last:
        out.append(_next_month(out[-1]))
    return out


def _month(c) -> F.Column:
    return F.trunc(F.col(c) if isinstance(c, str) else c, "month")


def stream_two_leg_incremental(flights: DataFrame, year: int, legs_path: str, trips_path: str,
                               checkpoint: str, gap_days: int = 2,
                               trigger: str | None = "available_now") -> StreamingQuery:
    """Two-leg trips maintained per touched month.

    State emits only the leg keys whose best flight changed in the batch
    (update mode). The best-leg table, a keyed table split by month, opens and
    replaces the touched months only. Trips are recomputed only for start months
    holding a changed first leg, or the date ``gap`` days before a changed
    second leg, and become those months' contents in the keyed trip table.
    Per-batch cost follows the months a batch touches, not the whole table;
    a stream in date order touches one or two. Readers see whole batches.
    """
    def sink(changed_state: DataFrame, batch_id: int) -> None:
        # used several times below: keep the batch (changed keys only) rather
        # than re-running source, parse and state read for every use
        changed = changed_state.select("side", *_KEY, "best.*").persist()
        try:
            _merge_and_rebuild(changed)
        finally:
            changed.unpersist()

    def _merge_and_rebuild(changed: DataFrame) -> None:
        spark = changed.sparkSession
        # months touched by one batch: a set bounded by the calendar (at most
        # 12 per year of data in the batch), used as static folder names
        months = sorted({r[0] for r in changed.select(_month("flight_date")).distinct().collect()})
        if not months:
            return
        # a changed second leg belongs to trips that start ``gap_days`` earlier
        gap = _dt.timedelta(days=gap_days)
        trip_months = sorted({x for m in months for x in _months(m - gap, m)})
        table = KeyedTable(spark, legs_path, changed.schema, ("side", *_KEY), month_of("flight_date"))
        table.upsert(changed)
        # legs of the trip months and of the months of their second legs
        need = sorted({x for m in trip_months
                       for x in _months(m, _next_month(m) - _dt.timedelta(days=1) + gap)})
        trips = trips_from_sided(table.read(_named(need)), gap_days)
        KeyedTable(spark, trips_path, trips.schema, TRIP_KEY, month_of("start_date")).replace(trips, _named(trip_months))

    return start(best_leg_state(flights, year), sink, checkpoint, "update", trigger)


def _named(months: list) -> list[str]:
    return [m.strftime("%Y-%m") for m in months]
