"""Top-k, per-group top-k, ranks with ties and arg-min per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyroute.session import scratch_path


def _order(spec: Sequence) -> list[Column]:
    """Order spec: column names (ascending), Columns, or (name, 'desc') pairs."""
    out = []
    for s in spec:
        if isinstance(s, Column):
            out.append(s)
        elif isinstance(s, tuple):
            name, how = s
            out.append(F.col(name).desc() if how == "desc" else F.col(name).asc())
        else:
            out.append(F.col(s).asc())
    return out


def top_k(df: DataFrame, order: Sequence, k: int = 10, rank: str | None = "rank") -> DataFrame:
    """Global top-k by ``order`` (full tie-break expected).

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: every task keeps
    its own k best, the driver merges at most k x tasks rows. The 1-based
    position is added after the limit, over at most k rows.
    """
    best = df.orderBy(*_order(order)).limit(k)
    if rank is None:
        return best
    # k rows at most: a window without partitioning is bounded here
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*_order(order))))


def top_k_by(df: DataFrame, group: Sequence[str] | str, order: Sequence, k: int = 10,
             rank: str = "rank") -> DataFrame:
    """Per-group top-k with 1-based position (no ties: position in the list).

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task sends at most k rows per group: a group
    holding a third of all rows is cut down before it is exchanged.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*_order(order))
    return (df.withColumn(rank, F.row_number().over(w))
              .filter(F.col(rank) <= k))


def best_by(df: DataFrame, keys: Sequence[str] | str, order: Sequence) -> DataFrame:
    """Arg-min per key: the first row of each key under ``order`` (full tie-break)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn("_pos", F.row_number().over(w))
              .filter(F.col("_pos") == 1).drop("_pos"))


_ROW = "_row"  # range partition << 33 | position in it


def _in_order(df: DataFrame, order: Sequence[Column], path: str | None) -> tuple[DataFrame, DataFrame]:
    """``df`` written once in range partitions, sorted, with each row's place in ``_row``; and the partitions' places.

    Spark takes the boundaries from a sample of the order keys' values, so partitions are of like size
    wherever the values lie, and puts NaN, infinities and nulls where its sort does. The rows are
    stored because a second run of the range shuffle could cut elsewhere.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or scratch_path(spark, "ordered")
    (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
       .withColumn(_ROW, F.monotonically_increasing_id()).write.parquet(path))
    stored = spark.read.parquet(path)
    return stored, F.shiftright(_ROW, 33)


def _starts(rows: DataFrame, weight: Column) -> DataFrame:
    """(_part, _start): the weight before each range partition; one row for each shuffle partition at most."""
    totals = rows.groupBy(F.shiftright(_ROW, 33).alias("_part")).agg(F.sum(weight).alias("_w"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_w").over(before), F.lit(0)).cast("long").alias("_start"))


def number_rows(df: DataFrame, order: Sequence, name: str = "row_number", path: str | None = None) -> DataFrame:
    """Total order: every row's 1-based number under ``order`` (a full tie-break, or equal rows share their numbers
    in any order), without a window over the whole table.

    Rows are range-partitioned and sorted, numbered inside their partition, and each partition starts
    after the rows of those before it. ``path`` keeps the sorted rows, else they go to the scratch folder.
    """
    rows, part = _in_order(df, _order(order), path)
    starts = F.broadcast(_starts(rows, F.lit(1)))
    number = F.col("_start") + F.col(_ROW).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(starts, part == F.col("_part")).select(*df.columns, number.alias(name))


def rank_with_ties(df: DataFrame, value: str, rank: str = "rank", descending: bool = True) -> DataFrame:
    """Competition rank (1, 2, 2, 4) of every row by ``value`` without one big task.

    rank(v) = 1 + number of rows whose value is strictly better. Steps:
      1. histogram of values (partial aggregate): one row per distinct value;
      2. distinct values in range partitions of like depth, sorted, stored;
      3. offset of each partition = rows in better partitions (a table with one
         row per shuffle partition, broadcast);
      4. inside a partition, a running sum over better values;
      5. join the rank of each value back to the rows.
    ``value`` is of any type that sorts, in Spark's order: NaN is the greatest,
    nulls rank last either way.
    """
    by = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    hist = df.groupBy(value).agg(F.count(F.lit(1)).alias("_h"))
    rows, part = _in_order(hist, [by], None)
    better = (Window.partitionBy("_part").orderBy(_ROW).rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("_part", part).join(F.broadcast(_starts(rows, F.col("_h"))), "_part")
    ranks = placed.select(
        F.col(value).alias("_v"),
        (F.lit(1) + F.col("_start") + F.coalesce(F.sum("_h").over(better), F.lit(0))).cast("long").alias(rank))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")
