"""Keyed tables: rows with a primary key, upserted a part at a time and published by one pointer swap.

The rows are split into parts by an expression of a row's columns: a hash of the partition key, or a
calendar unit. A write reads the touched parts only, writes their new contents into a folder of its own
and then replaces a small map (part -> version); the pointer to the map is swapped last. So readers see
all of a write or nothing of it, in all parts at once, untouched parts are neither read nor copied, and a
write that fails leaves nothing behind that anyone reads. Folders that a write replaced are deleted by
the next write: readers of the version before stay safe until then. One writer at a time.

    <path>/data/v=<version>/part=<value>/...   rows of a part
    <path>/maps/<version>                      the map, with the table's layout
    <path>/_current                            the pointer

The map has one entry per part, so its size is set by the number of buckets or by the calendar.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyroute.sources.versions import child_folders, create_text, current_version, point_to, read_text, remove

PART = "part"
DEFAULT_BUCKETS = 64


def bucket_of(columns: Sequence[str], buckets: int = DEFAULT_BUCKETS) -> str:
    """Part expression: one of ``buckets`` hash buckets of the columns (null is a value like others)."""
    return f"cast(pmod(xxhash64({', '.join(f'`{c}`' for c in columns)}), {buckets}) as string)"


def month_of(column: str) -> str:
    """Part expression: the month of a date."""
    return f"date_format(`{column}`, 'yyyy-MM')"


class KeyedTable:
    """A keyed table at ``path``. ``keys`` is the primary key, ``part`` the SQL expression of a row's part,
    which must follow from the key."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], part: str):
        self.spark, self.path, self.schema, self.keys, self.part = spark, path, schema, list(keys), part

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        """A table that has been written, with the layout it was written with."""
        if (state := _state(spark, path)) is None:
            raise FileNotFoundError(f"no keyed table at {path}")
        return cls(spark, path, StructType.fromJson(state["schema"]), state["keys"], state["by"])

    @property
    def batch(self) -> int | None:
        """The last batch that was applied."""
        return (_state(self.spark, self.path) or {}).get("batch")

    def parts(self) -> dict[str, int]:
        """Every part's version."""
        return (_state(self.spark, self.path) or {"parts": {}})["parts"]

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of all or of the given parts; folders of other parts are not listed."""
        known = self.parts()
        folders = [_folder(self.path, v, p) for p, v in known.items() if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def lookup(self, **key) -> DataFrame:
        """Rows whose columns equal ``key``; if the part follows from these columns, only that part is read."""
        rows = self.spark.range(1).select(*[F.lit(v).cast(self.schema[k].dataType).alias(k) for k, v in key.items()])
        needed = _columns_of(rows, self.part)
        found = self.read([rows.selectExpr(self.part).first()[0]] if needed else None)
        for k, v in key.items():
            found = found.filter(F.col(k) == F.lit(v))
        return found

    def upsert(self, changed: DataFrame, batch: int | None = None, add: Sequence[str] = ()) -> list[str]:
        """Put rows in by primary key (at most one row a key) and return the parts they lie in.

        Other rows of the same parts stay. Columns in ``add`` are added to those of the row that is there;
        then ``batch`` is needed, as a batch that was applied already must not be added again.
        """
        if add and batch is None:
            raise ValueError("adding needs a batch number")
        if batch is not None and (done := self.batch) is not None and batch <= done:
            return []
        rows = changed.select(*self.schema.names, F.expr(self.part).alias(PART))
        # at most one value for each part of the table
        parts = sorted(r[0] for r in rows.select(PART).distinct().collect())
        old = self.read(parts).select(*self.schema.names, F.expr(self.part).alias(PART))
        if add:
            merged = old.unionByName(rows).groupBy(PART, *self.keys).agg(*[F.sum(c).alias(c) for c in add])
        else:
            # The rows stand in the plan once: Spark takes only one of two uses of a stream's persisted batch from the cache
            # and runs the stream's step again, state included, for the other. A key comes once, so the hash table of
            # a task is small, and the table's rows need no sort.
            new = rows.select(*[F.col(c).alias(f"_{c}") for c in rows.columns], F.lit(True).alias("_new")).hint("shuffle_hash")
            merged = old.join(new, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.keys], "full_outer").select(
                *[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in rows.columns])
        self._write(merged, parts, batch)
        return parts

    def replace(self, rows: DataFrame, parts: Sequence[str], batch: int | None = None) -> None:
        """Make ``rows`` the whole content of ``parts`` (rows of other parts are refused by a filter)."""
        self._write(rows.select(*self.schema.names, F.expr(self.part).alias(PART)).filter(F.col(PART).isin(list(parts))),
                    parts, batch)

    def _write(self, rows: DataFrame, parts: Sequence[str], batch: int | None) -> None:
        if not parts:
            return
        at = current_version(self.spark, self.path)
        state = _state(self.spark, self.path) or {"parts": {}, "retired": [], "batch": None}
        for folder in state["retired"]:
            remove(self.spark, folder)
        version = 0 if at is None else at + 1
        (rows.repartition(len(parts), PART).select(*self.schema.names, PART)
             .write.mode("overwrite").partitionBy(PART).parquet(f"{self.path}/data/v={version}"))
        # a part without rows has no folder
        written = {f.split("=", 1)[1] for f in child_folders(self.spark, f"{self.path}/data/v={version}")
                   if f.startswith(f"{PART}=")}
        retired = [_folder(self.path, state["parts"][p], p) for p in parts if p in state["parts"]]
        new = {p: v for p, v in state["parts"].items() if p not in parts} | dict.fromkeys(sorted(written), version)
        text = json.dumps({"parts": new, "retired": retired, "batch": state["batch"] if batch is None else batch,
                           "keys": self.keys, "by": self.part, "schema": self.schema.jsonValue()})
        # left by a write that failed before the swap
        remove(self.spark, f"{self.path}/maps/{version}")
        create_text(self.spark, f"{self.path}/maps/{version}", text)
        point_to(self.spark, self.path, version)
        if at:
            remove(self.spark, f"{self.path}/maps/{at - 1}")


def _folder(path: str, version: int, part: str) -> str:
    return f"{path}/data/v={version}/{PART}={part}"


def _state(spark: SparkSession, path: str) -> dict | None:
    version = current_version(spark, path)
    return None if version is None else json.loads(read_text(spark, f"{path}/maps/{version}"))


def _columns_of(rows: DataFrame, expression: str) -> bool:
    """Whether the expression needs no other columns than ``rows`` has."""
    from pyspark.errors import AnalysisException
    try:
        return bool(rows.selectExpr(expression).columns)
    except AnalysisException:
        return False


def publish_keyed(df: DataFrame, path: str, by: Sequence[str], keys: Sequence[str],
                  buckets: int = DEFAULT_BUCKETS) -> KeyedTable:
    """Make ``df`` the whole content of a keyed table in hash buckets of ``by``: readers see the old table or the new."""
    table = KeyedTable(df.sparkSession, path, df.schema, keys, bucket_of(by, buckets))
    table.replace(df, [str(b) for b in range(buckets)])
    return table


def is_keyed(spark: SparkSession, path: str) -> bool:
    """Whether a keyed table was written at ``path``."""
    version = current_version(spark, path)
    return version is not None and read_text(spark, f"{path}/maps/{version}") is not None
