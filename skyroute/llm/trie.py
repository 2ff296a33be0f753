"""Prefix trie of conversations, found by peeling turns off from the deepest level up.

A node of depth d is a distinct sequence of d first turns. Peeling starts at the greatest
depth: conversations that end at a depth join the surviving nodes of the depth below, which
have lost their last turn; grouping both by the hash of what is left gives the nodes of this
depth with all their sums, so every node is found and counted in one pass. A node is known by
128 bits: the exclusive or of the hashes of (position, role, text) of its turns.

Depths up to ``SINGLE`` are peeled one by one. Greater depths, where few conversations are
left, are peeled a stretch at a time, from some depth to half of it, so that a conversation of
thousands of turns costs a dozen rounds: nodes of a stretch are grouped by hash; those that
have the same smallest conversation form a chain, which is summed along; only the top of a
chain adds its sums to its ancestors in the stretch. A conversation therefore sends no more
rows than it has turns. Grouping combines map-side, so a first turn or a whole conversation
that a third of all share is one row a task.

Cases: a null role or text is empty; a null turn comes first, equal turns are ordered by role
and hash; rows without a conversation id belong to no conversation and are left out; repeated
rows are turns of their own; other columns are ignored; an empty table gives an empty result.
The turns of one conversation lie in one task while they are ordered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyroute.llm.common import hinted, stored
from skyroute.session import scratch_path

#: Depths up to this one are peeled one by one.
SINGLE = 16
#: Ids that differ in this many low bits share a row while the ids of a node are put together.
IDS_BITS = 12

_KEY = ("k1", "k2")
_TURN = "array<struct<k1:bigint,k2:bigint,w:bigint>>"


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, i, t1, t2, w): the turns of each conversation numbered from 0, with two hashes of role and text
    and the number of words. Texts are not shuffled."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    by = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "t1", "t2")
    return (turns.where(F.col(conv).isNotNull())
            .select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), text("role").alias("role"),
                    text("text").alias("text"))
            .select("conv", "turn", "role", F.xxhash64("role", "text").alias("t1"),
                    F.xxhash64(F.lit(1), "text", "role").alias("t2"),
                    F.regexp_count("text", F.lit("[^ \\t-\\r]+")).cast("long").alias("w"))
            .select("conv", (F.row_number().over(by) - 1).alias("i"), "t1", "t2", "w"))


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, path) of every conversation of ``convs``; ``turns`` are rows like those of ``numbered_turns``.

    Entry d of a path has the hash of the first d turns and the words of turn d.
    """
    so_far = Window.partitionBy("conv").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    steps = turns.select("conv", "i", F.struct(F.bit_xor(F.xxhash64("i", "t1")).over(so_far).alias("k1"),
                                               F.bit_xor(F.xxhash64("i", "t2")).over(so_far).alias("k2"), "w").alias("step"))
    # conversations without a turn have an empty path
    rows = steps.unionByName(convs.select("conv", F.lit(None).cast("int").alias("i"),
                                          F.lit(None).cast(steps.schema["step"].dataType).alias("step")))
    gathered = F.array_sort(F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", "step"))))
    return (rows.groupBy("conv").agg(F.transform(gathered, lambda x: x["step"]).cast(_TURN).alias("path"))
            .select("conv", F.size("path").alias("depth"), "path"))


def _key_at(depth, name: str):
    """The hash of the first ``depth`` turns of ``path`` (0 for none)."""
    return F.coalesce(F.get("path", depth - 1)[name], F.lit(0).cast("long"))


def _keys(depth) -> list:
    return [_key_at(depth, k).alias(k) for k in _KEY]


def _schedule(deepest: int) -> list[tuple[int, int]]:
    """Stretches (lowest, highest depth) from the deepest one up."""
    out, high = [], deepest
    while high > SINGLE:
        low = max(SINGLE + 1, high // 2)
        out.append((low, high))
        high = low - 1
    return out + [(d, d) for d in range(high, -1, -1)]


_NODE = ["depth", *_KEY, "p1", "p2", "conv", "n_convs", "n_children", "n_leaves", "saved"]


def _level(depth: int, rows: DataFrame) -> DataFrame:
    """Nodes of one depth, with their paths, from the rows (classes and stripped nodes) that are left there."""
    d = F.lit(depth)
    words = F.coalesce(F.get("path", d - 1)["w"], F.lit(0).cast("long"))
    grouped = (rows.select(*_keys(d), _key_at(d - 1, "k1").alias("p1"), _key_at(d - 1, "k2").alias("p2"), words.alias("w"),
                           "conv", "n", "kids", "leaves", "saved", F.slice("path", 1, depth).alias("path"))
               .groupBy(*_KEY).agg(F.any_value("p1").alias("p1"), F.any_value("p2").alias("p2"), F.max("w").alias("w"),
                                   F.min("conv").alias("conv"), F.sum("n").alias("n_convs"),
                                   F.sum("kids").alias("n_children"), F.sum("leaves").alias("leaves"),
                                   F.sum("saved").alias("saved"), F.any_value("path").alias("path")))
    return grouped.select(F.lit(depth).alias("depth"), *_KEY, "p1", "p2", "conv", "n_convs", "n_children",
                          F.greatest("leaves", F.lit(1)).alias("n_leaves"),
                          (F.col("saved") + (F.col("n_convs") - 1) * F.col("w")).alias("saved"), "path")


def _stretch(low: int, high: int, rows: DataFrame) -> DataFrame:
    """Nodes of the depths ``low`` to ``high`` from the rows that are left there (stored, one for each ``conv``)."""
    at_end = lambda c: F.when(F.col("depth") == F.size("path"), F.col(c)).otherwise(0)
    d = F.col("depth")
    steps = rows.withColumn("depth", F.explode(F.sequence(F.lit(low), F.size("path"))))
    nodes = (steps.select("depth", *_keys(d), _key_at(d - 1, "k1").alias("p1"), _key_at(d - 1, "k2").alias("p2"),
                          F.get("path", d - 1)["w"].alias("w"), "conv", "n",
                          *[at_end(c).alias(c) for c in ("ended", "kids", "leaves", "saved")])
             .groupBy("depth", *_KEY)
             .agg(F.any_value("p1").alias("p1"), F.any_value("p2").alias("p2"), F.max("w").alias("w"),
                  F.min("conv").alias("conv"), F.sum("n").alias("n"),
                  *[F.sum(c).alias(c) for c in ("ended", "kids", "leaves", "saved")]))
    up = Window.partitionBy("conv").orderBy(F.desc("depth"))
    summed = up.rowsBetween(Window.unboundedPreceding, 0)
    chains = stored(nodes.select(
        "depth", *_KEY, "p1", "p2", "conv", F.col("n").alias("n_convs"),
        (F.col("kids") + F.lag("depth").over(up).isNotNull().cast("int")).alias("n_children"),
        F.sum(F.col("leaves") + (F.col("ended") == F.col("n")).cast("int")).over(summed).alias("n_leaves"),
        F.sum(F.col("saved") + (F.col("n") - 1) * F.col("w")).over(summed).alias("saved"),
        F.lead("depth").over(up).isNull().alias("top")), "chains")
    tops = (chains.where(F.col("top") & (d > low))
            .select("conv", d.alias("from"), F.col("n_leaves").alias("leaves"), F.col("saved").alias("adds"))
            .join(rows.select("conv", "path"), "conv")
            .withColumn("depth", F.explode(F.sequence(F.lit(low), F.col("from") - 1))))
    gifts = tops.select("depth", *_keys(d), (d == F.col("from") - 1).cast("long").alias("n_children"),
                        F.col("leaves").alias("n_leaves"), F.col("adds").alias("saved"))
    both = chains.drop("top").unionByName(gifts, allowMissingColumns=True)
    return (both.groupBy("depth", *_KEY)
            .agg(*[F.max(c).alias(c) for c in ("p1", "p2", "conv", "n_convs")],
                 *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved")])
            .select(*_NODE))


def _ends(convs: DataFrame) -> DataFrame:
    """(depth, keys, ends_sha256) of the nodes at which conversations end.

    Ids go in rows of a bounded number, and a task reads its nodes' rows in order, one at a time.
    """
    blocks = (convs.select("depth", *_keys(F.col("depth")), "conv")
              .groupBy("depth", *_KEY, F.shiftright("conv", IDS_BITS).alias("block"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
                   .alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for b in batches:
            for *at, ids in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if at == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = at, hashlib.sha256(ids.encode())
            if done:
                yield _batch(done)
                done = []
        if key is not None:
            yield _batch([(*key, digest.hexdigest())])

    return (blocks.repartition("depth", *_KEY).sortWithinPartitions("depth", *_KEY, "block")
            .select("depth", *_KEY, "ids").mapInArrow(run, "depth int, k1 long, k2 long, ends_sha256 string"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["depth", *_KEY, "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree), ends_sha256 (of the members that end here).

    ``turns`` are rows like those of ``numbered_turns``, ``convs`` lists every conversation (conv), also
    those without a turn.
    """
    spark = turns.sparkSession
    known = stored(paths(turns, convs), "trie-paths")
    classes = stored(known.select("conv", "depth", *_keys(F.col("depth")), "path").groupBy("depth", *_KEY)
                     .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.any_value("path").alias("path")),
                     "trie-classes")
    deepest = classes.agg(F.max("depth")).first()[0]
    root = scratch_path(spark, "trie-nodes")
    rounds, alive = [], None
    zero = [F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")]
    for k, (low, high) in enumerate(_schedule(deepest) if deepest is not None else []):
        rows = (classes.where(F.col("depth").between(low, high))
                .select("conv", "path", "n", F.col("n").alias("ended"), *zero))
        if alive is not None:
            rows = rows.unionByName(alive)
        if high > SINGLE:
            rows = stored(rows, "trie-rows")
        nodes = _stretch(low, high, rows) if high > SINGLE else _level(low, rows)
        nodes.write.parquet(f"{root}/round={k}")
        rounds.append(f"{root}/round={k}")
        top = spark.read.schema(nodes.schema).parquet(rounds[-1])
        if high > SINGLE:
            top = top.where(F.col("depth") == low).join(rows.select("conv", "path"), "conv")
        alive = top.select("conv", F.slice("path", 1, max(low - 1, 0)).alias("path"), F.col("n_convs").alias("n"),
                           F.lit(0).cast("long").alias("ended"), F.lit(1).cast("long").alias("kids"),
                           F.col("n_leaves").alias("leaves"), "saved")
    return _published(spark, rounds, _ends(known))


def _published(spark: SparkSession, rounds: list[str], ends: DataFrame) -> DataFrame:
    kinds = dict.fromkeys(_NODE, "long") | {"depth": "int"}
    schema = ", ".join(f"{c} {kinds[c]}" for c in _NODE)
    nodes = spark.read.schema(schema).parquet(*rounds) if rounds else spark.createDataFrame([], schema)
    inner = nodes.where("n_children > 0")
    parents = inner.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (nodes.join(hinted(parents, inner.count(), 48), ["depth", "p1", "p2"], "left")
            .join(ends, ["depth", *_KEY], "left")
            .select(F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                    "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))
