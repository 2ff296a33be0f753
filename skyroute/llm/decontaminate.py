"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

``build_index`` stores the postings (row, term, position) of every training token whose
term some test text uses; other terms' lists are never read. The postings lie in the
shards in which the documents were read, so building them moves nothing and a frequent
term's list is spread over all shards. A posting of the term -1 closes each document and
holds its id and its length.

``phrase_matches`` takes each test window's terms from the rarest on (by the number of
postings): the list of the rarest term, minus its offset in the window, gives candidate
starts; the offset-adjusted list of the second rarest is intersected with them; the
other terms' lists are intersected for the documents that remain. ``proximity_matches``
accepts the terms of a window in any order within ``span`` words of its rarest term.

Words are maximal runs of digits, letters and non-ASCII characters, A-Z in lower case.

Cases: null and empty texts have no words; an item of fewer words than a window is one
window, an item without words none; repeated rows are judged each; a null item id is
the item named ``null``; columns besides the named ones are ignored; empty tables give
no match (an empty training table an empty result).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyroute.llm.common import ascii_lower, hinted, stored

#: Characters between words, after lower-casing: ASCII without digits and a-z.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_BREAK_CHARS = "".join(chr(i) for i in range(128) if not chr(i).isdigit() and not "a" <= chr(i) <= "z")
#: The pseudo term of the posting that closes a document.
CLOSING = -1


def words(text: Column) -> Column:
    """Array of the text's words; empty for null."""
    body = F.btrim(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(_BREAK_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, BREAKS))


@dataclass
class Windows:
    """Windows of the test items as relations; all of them grow with the test set only."""

    terms: DataFrame  #: term string, term_id long
    entries: DataFrame  #: window_id long, term_id long, offset int
    items: DataFrame  #: window_id long, item string
    sizes: DataFrame  #: window_id long, n int
    rows: int  #: number of entries; no other relation here has more rows than it, but for ``items``
    term_bytes: int  #: size of ``terms``
    item_bytes: int  #: size of ``items``


def item_windows(items: DataFrame, item_col: str, text_col: str, size: int) -> Windows:
    """Every ``size`` consecutive words of an item (all of them, if fewer) as one window; equal windows once."""
    w = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                     words(F.col(text_col)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    spans = (w.where(F.size("words") > 0).select("item", "words", F.explode(starts).alias("start"))
             .select("item", F.slice("words", F.col("start"), F.lit(size)).alias("window")))
    found = stored(spans.distinct(), "test-windows")
    distinct = stored(found.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id()),
                      "test-ids")
    entries = distinct.select("window_id", F.posexplode("window").alias("offset", "term"))
    terms = stored(entries.select("term").distinct()
                   .withColumn("term_id", F.monotonically_increasing_id()), "test-terms")
    entries = stored(entries.join(terms, "term").select("window_id", "term_id", "offset"), "test-entries")
    named = stored(found.join(distinct, "window").select("window_id", "item"), "test-items")
    size_of = lambda df, c: df.agg(F.sum(F.octet_length(c) + 96)).first()[0] or 0
    return Windows(terms, entries, named, distinct.select("window_id", F.size("window").alias("n")), entries.count(),
                   size_of(terms, "term"), size_of(named, "item"))


def build_index(docs: DataFrame, id_col: str, text_col: str, tests: Windows) -> DataFrame:
    """Stored postings (row, term_id, pos, id): ``row`` is internal and unique per row of ``docs``."""
    end = F.array(F.lit(""))
    tokens = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                         F.concat(words(F.col(text_col)), end).alias("tokens"))
    postings = tokens.select("row", "id", F.posexplode("tokens").alias("pos", "term"))
    closing = tests.terms.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(CLOSING).cast("long").alias("term_id"))
    terms = hinted(tests.terms.unionByName(closing), tests.term_bytes, 1)
    return stored(postings.join(terms, "term").select(
        "row", "term_id", "pos", F.when(F.col("term_id") == CLOSING, F.col("id")).alias("id")), "postings")


def _ranked(index: DataFrame, tests: Windows) -> DataFrame:
    """The windows' entries with ``rank`` 0 for the rarest term (then by offset); absent terms are rarest."""
    sizes = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("window_id").orderBy("df", "offset")
    return stored(tests.entries.join(sizes, "term_id", "left").withColumn("df", F.coalesce("df", F.lit(0)))
                  .withColumn("rank", F.row_number().over(order) - 1), "test-ranks")


def _list(index: DataFrame, ranked: DataFrame, tests: Windows, rank: int) -> DataFrame:
    """Window starts that the posting lists of the terms of one rank allow."""
    own = hinted(ranked.where(F.col("rank") == rank).select("window_id", "term_id", "offset"), tests.rows, 48)
    return (index.join(own, "term_id").where("pos >= offset")
            .select("window_id", "row", (F.col("pos") - F.col("offset")).alias("start")))


def phrase_matches(index: DataFrame, tests: Windows) -> DataFrame:
    """(window_id, row, start): all exact occurrences of the windows."""
    ranked = _ranked(index, tests)
    key = ["window_id", "row", "start"]
    # windows of one term are matched by the first list alone
    first = _list(index, ranked, tests, 0)
    second = _list(index, ranked, tests, 1)
    single = tests.sizes.where("n = 1").select("window_id")
    pairs = first.join(second, key)
    some = stored(pairs.unionByName(first.join(hinted(single, tests.rows, 16), "window_id", "left_semi")), "candidates")

    rest = ranked.where("rank >= 2").select("window_id", "term_id", "offset")
    need = some.join(hinted(rest, tests.rows, 48), "window_id").select(
        *key, "term_id", (F.col("start") + F.col("offset")).alias("pos"))
    rows = stored(some.select("row").distinct(), "candidate-rows")
    asked = index.where(F.col("term_id") != CLOSING).join(hinted(rows, rows.count(), 32), "row", "left_semi")
    met = need.join(asked.select("row", "term_id", "pos"), ["row", "term_id", "pos"]).groupBy(key).agg(
        F.count(F.lit(1)).alias("met"))
    whole = some.join(met, key, "left").join(hinted(tests.sizes, tests.rows, 24), "window_id")
    return whole.where("coalesce(met, 0) = greatest(n - 2, 0)").select(key)


def proximity_matches(index: DataFrame, tests: Windows, span: int) -> DataFrame:
    """(window_id, row, pos): occurrences of a window's rarest term with all its other terms within ``span`` words."""
    ranked = _ranked(index, tests)
    own = ranked.groupBy("window_id", "term_id").agg(F.min("rank").alias("rank"))
    listed = index.join(hinted(own, tests.rows, 48), "term_id").select("window_id", "term_id", "rank", "row", "pos")
    block = F.floor(F.col("pos") / span)
    anchors = listed.where("rank = 0").select("window_id", "row", F.col("pos").alias("at"),
                                              F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    others = listed.where("rank > 0").select("window_id", "row", "term_id", "pos", block.alias("block"))
    met = (anchors.join(others, ["window_id", "row", "block"]).where(F.abs(F.col("pos") - F.col("at")) <= span)
           .groupBy("window_id", "row", "at").agg(F.count_distinct("term_id").alias("met")))
    terms = own.groupBy("window_id").agg((F.count(F.lit(1)) - 1).alias("others"))
    starts = listed.where("rank = 0").select("window_id", "row", F.col("pos").alias("at"))
    return (starts.join(met, ["window_id", "row", "at"], "left").join(hinted(terms, tests.rows, 24), "window_id")
            .where("coalesce(met, 0) = others").select("window_id", "row", F.col("at").alias("pos")))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated) of every row of ``docs``."""
    tests = item_windows(items, item_col, item_text_col, size)
    index = build_index(docs, id_col, text_col, tests)
    matches = stored(phrase_matches(index, tests), "matches")

    spans = matches.join(hinted(tests.sizes, tests.rows, 24), "window_id").groupBy("row", "start").agg(
        (F.col("start") + F.max("n")).alias("end"))
    before = F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    hits = (spans.withColumn("from", F.greatest("start", F.coalesce(before, F.lit(0))))
            .groupBy("row").agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit")))
    seen = (matches.select("row", "window_id").distinct().join(hinted(tests.items, tests.item_bytes, 1), "window_id")
            .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items")))
    ends = index.where(F.col("term_id") == CLOSING).select("row", "id", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (ends.join(hits, "row", "left").join(seen, "row", "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", none).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
