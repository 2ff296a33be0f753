"""Corpus pipeline: documents -> identified language -> near-dedup -> decontamination -> mixture -> shards.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of
documents (the last one adds ``shard`` and ``slot``). ``run`` writes every stage's result
to the shared folder and reads it back.

Decisions hold for rows, not for ids: language and contamination follow from a row's text, and
where ids are missing or repeated, near duplicates are found among numbered rows. Empty tables
stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.llm import decontaminate, langid, mixing, near_dedup, sharding
from skyroute.llm.common import hinted, id_fold, read, stored

SHARDS, SEED = 24, 20_260_101
#: Token budget of the mixture: this share of the tokens that reach the stage.
MIX_KEEP = 0.5


def without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """``docs`` whose ``key`` is not in ``gone`` (one column ``__gone``)."""
    gone = stored(gone.distinct(), "gone")
    return docs.join(hinted(gone, gone.count(), 64), key.eqNullSafe(F.col("__gone")), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decodes every text to a language and drops those that are in none (``und``): texts without a letter, and longer
    ones that give the language classifiers no evidence."""
    return langid.keep_identified(docs, langid.fit(docs.where(id_fold(F.col("doc_id")) != 2)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of documents alike in 0.8 or more of their five-word shingles.

    If an id is missing or repeated, rows are numbered in the order of their ids (none last) and
    the hashes of their texts, and the first row of each group stays.
    """
    unclear = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if unclear.isEmpty():
        rows, id_col = docs, "doc_id"
    else:
        helped = docs.withColumn("__none", F.col("doc_id").isNull()).withColumn("__text_hash", F.xxhash64("text"))
        rows, id_col = sharding.numbered(helped, ["__none", "doc_id", "__text_hash"], "__row")[0], "__row"
    found = near_dedup.near_duplicates(rows, id_col=id_col, k=5, percent=80)
    return without(rows, F.col(id_col), found.where("not kept").select(F.col(id_col).alias("__gone"))).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without any ten-word window of a benchmark item; a text is known by its digest."""
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    found = decontaminate.contamination(docs.select(digest.alias("digest"), "text"), read(spark, sf_dir, "benchmark"),
                                        size=10, id_col="digest")
    return without(docs, digest, found.where("contaminated").select(F.col("digest").alias("__gone")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples ``MIX_KEEP`` of the tokens so that source, language and topic follow their tempered shares."""
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic(F.col("text"))}
    mixed = mixing.mix(docs, dims, mixing.n_tokens(F.col("text")), power=0.85, seed=SEED, keep=MIX_KEEP)
    return mixed.where("__sampled").select(docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with shard and slot."""
    return sharding.shard_rows(docs, ["doc_id"], SHARDS, SEED)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("sharding", sharding_stage)]

#: MinHash candidates, the fitted language model and the permutation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
