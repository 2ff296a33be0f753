"""Archive ingest and input listings.

* ``list_input_files``: recursive listing as a DataFrame (path, length);
  Spark's file index already hides ``_*`` / ``.*`` entries (``_SUCCESS``,
  ``_temporary``); a producer's listing leaves out empty files.
* ``archive_members``: the members of every ``.zip`` (in any case) under a
  root, from the archives' directories, which tasks read; ``.html`` is
  ignored, other file types are refused.
* ``stage_archives``: every ``.csv`` member's lines, stored in one pass. A task
  takes members, not archives, so a large archive is read by several tasks;
  each member is decompressed once, its checksum tested as its lines go by.
* ``archive_lines``: the lines of the archives without a fault. A staged
  archive counts only if none of its members failed, so a corrupt archive
  (also an empty one) gives one row with an ``error`` and no lines. Storage
  errors are not corruption: they fail the task, which Spark retries.
* ``write_text_chunks``: gzip text files of at most N lines each.
* ``first_file_per_directory`` / ``first_file_per_listing_group``: one file
  per directory, from a file source or from a listing's line order.

Spark's file index lists the archives; tasks open them through Arrow's
filesystem layer (a member's stream is not splittable, but a zip is seekable) and
emit lines in bounded Arrow batches. Archive bytes never sit in a DataFrame row, so
there is no per-file size limit and no batch of many whole archives in memory.
"""

from __future__ import annotations

import io
import os
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyroute.session import scratch_path

# Extensions the ingest understands.
ARCHIVE_EXTENSIONS = (".zip",)
IGNORED_EXTENSIONS = (".html",)
MEMBER_EXTENSION = ".csv"
LINES_PER_CHUNK = 1_000_000

ARCHIVE_LINE_SCHEMA = "archive string, member string, line_no long, line string, error string"
_OUT_BATCH = 10_000
#: Compressed bytes of the members that one task reads.
TASK_BYTES = 64 << 20


# What a damaged archive raises while its members are read.
CORRUPT = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError)


def list_input_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modification_time) of every non-empty file below ``root``
    (Spark's file sources never show empty ones).

    Selecting no ``content`` column means the files are listed, not read.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return r.load(root).select("path", "length", "modificationTime").filter(F.col("length") > 0)


def _open_input(path: str):
    """Seekable handle on a file URI (local, HDFS, object stores) via Arrow's
    filesystems, opened inside the task: archive bytes never travel in rows."""
    from pyarrow import fs as pafs
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    filesystem, inner = pafs.FileSystem.from_uri(quote(path, safe="/:@"))
    return filesystem.open_input_file(inner)


@contextmanager
def _archive(path: str):
    """An open archive; files too small to be one (such as empty ones) are corrupt archives."""
    with _open_input(path) as handle:
        if handle.size() < zipfile.sizeEndCentDir:
            raise zipfile.BadZipFile(f"a file of {handle.size()} bytes is no zip file")
        with zipfile.ZipFile(handle) as zf:
            yield zf


def archive_paths(spark: SparkSession, root: str, check_types: bool = True) -> DataFrame:
    """(archive): the ``.zip`` files below ``root``, empty ones included, from Spark's own (parallel) file index.

    Raises when a file is neither an archive nor an ignored type.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    # the names that the index holds on the driver anyway; a scan would leave out empty files
    paths = listed.inputFiles()
    kind = {p: os.path.splitext(p)[1].lower() for p in paths}
    if check_types and (bad := [p for p in paths if kind[p] not in ARCHIVE_EXTENSIONS + IGNORED_EXTENSIONS]):
        raise ValueError(f"unsupported input file type: {bad[0]}")
    zips = [(unquote(p),) for p in paths if kind[p] in ARCHIVE_EXTENSIONS]
    tasks = max(1, min(len(zips), 4 * spark.sparkContext.defaultParallelism))
    return spark.createDataFrame(zips, "archive string").repartition(tasks, "archive")


def archive_members(archives: DataFrame) -> DataFrame:
    """(archive, member, bytes, error): one row per ``.csv`` member, or per archive whose directory can't be read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: list[tuple] = []
            for path in pdf["archive"]:
                try:
                    with _archive(path) as zf:
                        found += [(path, i.filename, i.compress_size, None) for i in zf.infolist()
                                  if not i.is_dir() and i.filename.lower().endswith(MEMBER_EXTENSION)]
                except CORRUPT as e:
                    found.append((path, None, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(found, columns=["archive", "member", "bytes", "error"])

    return archives.mapInPandas(run, "archive string, member string, bytes long, error string")


def _member_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of the members; a member that fails ends with a row that has an ``error``."""
    buf: list[tuple] = []
    at, opened = None, ExitStack()
    for pdf in batches:
        for path, member, fault in zip(pdf["archive"], pdf["member"], pdf["error"], strict=True):
            if member is None:
                buf.append((path, None, None, None, fault))
                continue
            try:
                if path != at:
                    opened.close()
                    at, zf = None, opened.enter_context(_archive(path))
                    at = path
                with zf.open(member) as raw:
                    text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="")
                    for i, line in enumerate(text):
                        buf.append((path, member, i, line.rstrip("\r\n"), None))
                        if len(buf) >= _OUT_BATCH:
                            yield pd.DataFrame(buf, columns=_COLS)
                            buf = []
            except CORRUPT as e:
                buf.append((path, member, None, None, f"{type(e).__name__}: {e}"))
    opened.close()
    if buf:
        yield pd.DataFrame(buf, columns=_COLS)


_COLS = ["archive", "member", "line_no", "line", "error"]


def stage_archives(spark: SparkSession, root: str, path: str, check_types: bool = True,
                   task_bytes: int = TASK_BYTES) -> None:
    """Store the lines of all members of all archives below ``root``, and the faults, at ``path``: one pass.

    Members are dealt to tasks of about ``task_bytes`` compressed bytes, those of an archive side by side.
    """
    found = scratch_path(spark, "archive-members")
    archive_members(archive_paths(spark, root, check_types)).write.parquet(found)
    members = spark.read.parquet(found)
    total, n = members.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, min(n, -(-total // task_bytes)))
    (members.repartitionByRange(tasks, "archive", "member").sortWithinPartitions("archive", "member")
            .select("archive", "member", "error").mapInPandas(_member_lines, ARCHIVE_LINE_SCHEMA).write.parquet(path))


def staged_lines(spark: SparkSession, path: str) -> DataFrame:
    """What counts of staged archives: the lines of archives without a fault, and one row with the (first)
    ``error`` for each of the others."""
    staged = spark.read.schema(ARCHIVE_LINE_SCHEMA).parquet(path)
    faults = (staged.where(F.col("error").isNotNull()).groupBy("archive")
                    .agg(F.min_by("error", F.coalesce("member", F.lit(""))).alias("error")))
    whole = staged.where(F.col("error").isNull()).join(faults.select("archive"), "archive", "left_anti")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("member", "string"), ("line_no", "long"), ("line", "string"))]
    return whole.select(*_COLS).unionByName(faults.select("archive", *nothing, "error"))


def archive_lines(spark: SparkSession, root: str, check_types: bool = True) -> DataFrame:
    """Lines of the ``.csv`` members of all sound ``.zip`` archives below ``root``, staged in the scratch folder."""
    path = scratch_path(spark, "archive-lines")
    stage_archives(spark, root, path, check_types)
    return staged_lines(spark, path)


def write_text_chunks(lines: DataFrame, out: str, lines_per_file: int = LINES_PER_CHUNK,
                      compression: str = "gzip", line: str = "line") -> None:
    """Good lines as gzip text files of at most ``lines_per_file`` lines."""
    (lines.filter(F.col("error").isNull() if "error" in lines.columns else F.lit(True))
          .select(F.col(line).alias("value"))
          .write.mode("overwrite").option("compression", compression)
          .option("maxRecordsPerFile", lines_per_file).text(out))


def archive_errors(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("error").isNotNull()).select("archive", "error")


# -- one file per directory ---------------------------------------------------

def first_file_per_directory(files: DataFrame, path: str = "path") -> DataFrame:
    """On a file source: the first file (by name) of every directory."""
    parent = F.regexp_extract(F.col(path), r"^(.*)/[^/]*$", 1)
    return files.groupBy(parent.alias("directory")).agg(F.min(path).alias("first_file"))


def _has_extension(line) -> F.Column:
    """A listing entry with a file extension counts as a file (leading dots of
    the base name do not make an extension)."""
    base = F.regexp_replace(F.regexp_extract(line, r"[^/]*$", 0), r"^\.+", "")
    return base.contains(".")


def first_file_per_listing_group(spark: SparkSession, listing_path: str) -> DataFrame:
    """A plain listing read in line order: every directory line starts a new
    group, and the first file line of each group is taken.

    Line order is (file, split start, position in split). The last directory
    seen before each line is carried forward in two steps: inside a split by a
    window partitioned by split, across splits through a table with one row
    per split (its last directory), so no task holds more than one split.
    """
    lines = (spark.read.text(listing_path)
                  .select(F.trim("value").alias("entry"),
                          F.col("_metadata.file_path").alias("_f"),
                          F.col("_metadata.file_block_start").alias("_s"),
                          F.monotonically_increasing_id().alias("_i"))
                  .filter(F.col("entry") != ""))
    lines = lines.withColumn("_dir", ~_has_extension(F.col("entry")))
    order = F.struct("_f", "_s", "_i")
    lines = lines.withColumn("_o", order)
    dir_key = F.when(F.col("_dir"), F.col("_o"))
    per_split = lines.groupBy("_f", "_s").agg(F.max(dir_key).alias("_last"))
    # one row per input split: bounded by input size / split size
    carried = per_split.withColumn(
        "_carry", F.max("_last").over(Window.orderBy("_f", "_s")
                                      .rowsBetween(Window.unboundedPreceding, -1)))
    within = Window.partitionBy("_f", "_s").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    grouped = (lines.join(carried.select("_f", "_s", "_carry"), ["_f", "_s"])
                    .withColumn("_group", F.coalesce(F.max(dir_key).over(within), F.col("_carry"))))
    files = grouped.filter(~F.col("_dir"))
    return (files.groupBy("_group")
                 .agg(F.min_by("entry", "_o").alias("first_file"))
                 .select("first_file"))
