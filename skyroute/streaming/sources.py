"""Stream sources behind one switch: kafka, socket, text files, table files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_source(spark: SparkSession, kind: str, path: str | None = None, schema=None,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None,
                  servers: str | None = None, topic: str | None = None,
                  group_id: str | None = None, host: str | None = None,
                  port: int | None = None, **options) -> DataFrame:
    """A streaming DataFrame.

    kind='kafka'  -> (key, value) strings from ``topic``, from the earliest offset
    kind='socket' -> value lines from host:port
    kind='text'   -> value lines of new text files under ``path``
    kind='files'  -> rows of new ``fmt`` files under ``path`` with ``schema``
    File kinds take one file per trigger when ``max_files_per_trigger=1``
    (micro-batches in file order), as a queue of batches would.
    """
    r = spark.readStream
    if kind == "kafka":
        r = (r.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
        if group_id:
            r = r.option("kafka.group.id", group_id)
        return r.options(**options).load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    if kind == "socket":
        return r.format("socket").option("host", host).option("port", port).load()
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    r = r.options(**options)
    if kind == "text":
        return r.text(path)
    if kind == "files":
        return r.schema(schema).format(fmt).load(path)
    raise ValueError(f"unknown stream kind {kind!r}")


def split_to_batches(df: DataFrame, path: str, batch) -> None:
    """Write ``df`` as input batches: every task adds its files to the folders ``part=i``.

    ``batch`` is an expression giving each row's batch; every row lands in
    exactly one. Nothing is shuffled, so a batch has as many files as the input
    has splits. Used to replay a table as a stream.
    """
    out = df.withColumn("batch", batch.cast("int")).withColumn("part", F.col("batch"))
    out.write.mode("overwrite").partitionBy("part").parquet(path)


def batch_streams(spark: SparkSession, path: str, n: int, schema: str) -> list[DataFrame]:
    """The ``n`` batches of ``split_to_batches`` as streams to be drained one after the other.

    Stream i sees the folders 0 to i and, by its query's checkpoint, takes what is
    new: all files of batch i as one micro-batch. So the order is that of the
    batch numbers and does not depend on file times.
    """
    seen = [",".join(map(str, range(i + 1))) for i in range(n)]
    return [stream_source(spark, "files", f"{path}/part={{{s}}}", schema=schema) for s in seen]
