"""Reproducible shuffle into shards by a keyed permutation of global row numbers.

Rows are numbered 0 .. n-1 in the order of ``order_by`` (a range shuffle, then each
partition's rows after those of the partitions before it). A balanced Feistel network
over the next power of four, walked again until the value is below n, permutes the
numbers. The permuted number p gives ``shard = p mod shards`` and ``slot = p div
shards``: counts differ by one at most and slots have no gaps. The same seed and row
order give the same result on any cluster, and ``locate`` / ``row_at`` compute shard
and slot of a row number, and the reverse, without any table.

Cases: null order values come first; ties are numbered in scan order (rows equal in
all columns are interchangeable); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from skyroute.llm.common import stored

ROUNDS = 6
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64 (fixed public constants); wraps modulo 2**64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A bijection of 0 .. n-1 that ``seed`` decides."""

    def __init__(self, n: int, seed: int):
        self.n = n
        self.half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        start = np.arange(1, ROUNDS + 1, dtype=np.uint64) * _MIX[0] + np.uint64(seed & (2**64 - 1))
        self.keys = _mixed(start)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        if back:
            for k in self.keys[::-1]:
                left, right = right ^ (_mixed(left + k) & self.mask), left
        else:
            for k in self.keys:
                left, right = right, left ^ (_mixed(right + k) & self.mask)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        y = self._once(np.asarray(x).astype(np.uint64), back)
        while (out := y >= np.uint64(self.n)).any():
            y[out] = self._once(y[out], back)
        return y.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, False)

    def inverse(self, y: np.ndarray) -> np.ndarray:
        return self._walk(y, True)


def locate(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """(shard, slot) of a row number."""
    p = int(Permutation(n, seed).forward(np.array([row]))[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The row number that lies in a shard's slot."""
    return int(Permutation(n, seed).inverse(np.array([slot * shards + shard]))[0])


def numbered(df: DataFrame, order_by: list[str], column: str) -> tuple[DataFrame, int]:
    """``df`` with global row numbers in ``column``, and the number of rows.

    The sorted rows are written once to the shared folder, so the numbers never depend
    on a second run of the range shuffle. The only thing that meets in one task, and is
    broadcast, is one count per shuffle partition.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in order_by]
    tie = "__scan_order"
    ordered = (df.withColumn(tie, F.monotonically_increasing_id())
               .repartitionByRange(parts, *keys, F.col(tie)).sortWithinPartitions(*keys, F.col(tie)).drop(tie)
               .withColumn(column, F.monotonically_increasing_id()))
    rows = stored(ordered, "numbered")
    part = F.shiftright(F.col(column), 33)
    counts = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    n = counts.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    return (rows.join(F.broadcast(starts), part == F.col("__part"))
            .withColumn(column, F.col("__start") + F.col(column).bitwiseAND((1 << 33) - 1))
            .drop("__part", "__start")), n


def shard_rows(df: DataFrame, order_by: list[str], shards: int, seed: int,
               shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """``df`` with its shard (int) and slot (long); columns of those names are replaced."""
    df = df.drop(shard_col, slot_col)
    rows, n = numbered(df, order_by, "__row")

    @pandas_udf("long")
    def permuted(x: pd.Series) -> pd.Series:
        return pd.Series(Permutation(n, seed).forward(x.to_numpy()))

    return (rows.withColumn("__row", permuted("__row"))
            .withColumn(shard_col, (F.col("__row") % shards).cast("int"))
            .withColumn(slot_col, F.expr(f"__row div {shards}"))
            .drop("__row"))
