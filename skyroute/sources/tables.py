"""Published result tables and point lookups.

``publish`` writes a Parquet table partitioned by the partition key and replaces whole
partitions, in place: right for ranked lists that are computed whole. Tables that are
upserted by primary key while others read them are keyed tables (``sources.keyed``).
A point lookup filters on the partition columns so the scan prunes to one folder; for
lookups by other columns a table can be sorted by them and carry bloom filters, so that
few row groups are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.sources.keyed import KeyedTable, is_keyed


def publish(df: DataFrame, path: str, partition_cols: Sequence[str] | str,
            mode: str = "overwrite", cluster: bool = True, sort: Sequence[str] = (),
            bloom: Sequence[str] = (), row_group_bytes: int | None = None) -> None:
    """Write ``df`` partitioned by the key; replaces only the keys it holds.

    ``cluster=True`` gathers each key's rows into one task first (one file per
    key): right for ranked tables, whose rows per key are bounded by k. For
    tables with unbounded rows per key use ``cluster=False``: every task
    writes its own rows sorted by key, so no key is gathered in one task.

    ``sort`` orders the rows inside each file by further columns, so that the row
    groups' minimum and maximum tell them apart; ``bloom`` writes Parquet bloom
    filters of columns that have no order in common with the rest. Readers skip row
    groups by both for any lookup on these columns; small row groups skip more.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    out = df.repartition(*[F.col(c) for c in cols]) if cluster else df
    if sort or not cluster:
        out = out.sortWithinPartitions(*cols, *sort)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    w.partitionBy(*cols).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a published table, keyed or not."""
    return KeyedTable.open(spark, path).read() if is_keyed(spark, path) else spark.read.parquet(path)


def lookup(spark: SparkSession, path: str, order: Sequence[str] | str = ("rank",),
           limit: int | None = None, **key) -> DataFrame:
    """Rows of the published table whose key columns equal ``key``, in clustering order."""
    order = [order] if isinstance(order, str) else list(order)
    if is_keyed(spark, path):
        df = KeyedTable.open(spark, path).lookup(**key)
    else:
        df = spark.read.parquet(path)
        for k, v in key.items():
            df = df.filter(F.col(k) == F.lit(v))
    df = df.orderBy(*order)
    return df.limit(limit) if limit else df
