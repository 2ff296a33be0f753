"""Counting and averaging operators (all combine map-side before the shuffle)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def popularity(df: DataFrame, cols: Sequence[str] = ("origin", "dest"),
               key: str = "airport", count: str = "count") -> DataFrame:
    """Occurrences of each value across several columns (origin + destination).

    Equal to counting each column and summing the partial counts after a
    union, but one scan and one shuffle: the columns are unpivoted with
    ``explode(array(...))`` and counted with a partial (map-side) aggregate,
    so a hub holding a third of the rows costs one row per map task.
    """
    return (df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(key))
              .groupBy(key).agg(F.count(F.lit(1)).alias(count)))


def count_by(df: DataFrame, keys: Sequence[str] | str, count: str = "count") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def mean_by(df: DataFrame, keys: Sequence[str] | str, metric: str, name: str | None = None) -> DataFrame:
    """Mean of ``metric`` per key; rows whose metric is null do not count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.filter(F.col(metric).isNotNull())
              .groupBy(*keys).agg(F.avg(metric).alias(name or f"mean_{metric}")))


def sum_count_by(df: DataFrame, keys: Sequence[str] | str, metric: str) -> DataFrame:
    """Mergeable form of a mean: (sum, count) per key; merge with ``merge_means``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.filter(F.col(metric).isNotNull())
              .groupBy(*keys).agg(F.sum(metric).alias("total"), F.count(F.lit(1)).alias("n")))


def merge_means(partials: DataFrame, keys: Sequence[str] | str, name: str) -> DataFrame:
    """Combine (total, n) partials into the mean per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (partials.groupBy(*keys)
                    .agg((F.sum("total") / F.sum("n")).alias(name)))


def tokens(df: DataFrame, col: str = "text", sep: str = " ", word: str = "word") -> DataFrame:
    """Split a text column on a literal separator; empty tokens are kept."""
    return df.select(F.explode(F.split(F.col(col), re.escape(sep), -1)).alias(word))


def wordcount(df: DataFrame, col: str = "text", sep: str = " ",
              word: str = "word", count: str = "count") -> DataFrame:
    """Occurrences of each token over whole texts."""
    return count_by(tokens(df, col, sep, word), word, count)
