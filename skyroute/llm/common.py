"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.session import scratch_path

#: ``broadcast()`` is hinted only for tables whose measured size is at most this many bytes.
BROADCAST_BYTES = 64 << 20
#: Distinct words whose hashes a Python worker keeps.
KEPT_WORDS = 100_000


class WordHashes(dict):
    """64-bit hashes of words, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage, outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_uri(spark: SparkSession, path: str) -> str:
    """``path`` as a URI of the store it lies in, for tasks that open files by themselves."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()
    return uri if "://" in uri else uri.replace(":/", ":///", 1)


def small_enough(rows: int, bytes_per_row: int) -> bool:
    return rows * bytes_per_row <= BROADCAST_BYTES


def hinted(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast hint if the counted rows fit the byte bound; otherwise a plain shuffle join."""
    return F.broadcast(df) if small_enough(rows, bytes_per_row) else df


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that on pure ASCII texts and is far cheaper."""
    upper = "".join(map(chr, range(65, 91)))
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, upper, upper.lower())))


def id_fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 4; a null id counts as held out (2)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(2))
