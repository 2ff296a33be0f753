"""Registered queries of the subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.llm import (
    bm25, chat, decontaminate, langid, mixing, near_dedup, periodic, quality, sharding, substrings, token_counts, trie, warc,
)
from skyroute.llm.common import hinted, id_fold, read, stored
from skyroute.session import scratch_path

SHARDS, SEED = 24, 20_260_101
MIX_POWER, MIX_ROUNDS = 0.7, 12


def tokenizer_path(name: str) -> str:
    """A vocabulary file: in $TOKENIZER_DIR if that is set, else of the installed package."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic(F.col("text"))}
    mixed = mixing.mix(docs, dims, mixing.n_tokens(F.col("text")), power=MIX_POWER, rounds=MIX_ROUNDS, seed=SEED)
    return mixed.select("doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"),
                        F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"),
                        F.col("__weight").alias("weight"), F.col("__probability").alias("probability"),
                        F.col("__draw").alias("draw"), F.col("__sampled").alias("sampled"))


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.shard_rows(thin, ["doc_id", "text_crc32", "size"], SHARDS, SEED)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), k=2, percent=80)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    fold = id_fold(F.col("doc_id"))
    machine = quality.fit(docs, labels.where(fold != 2).select("doc_id", "quality"))
    return quality.score(docs, machine).withColumn("held_out", fold == 2)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = id_fold(F.col("doc_id"))
    model = langid.fit(docs.where(fold != 2))
    return langid.predict(docs, model).withColumn("held_out", fold == 2)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = stored(chat.format_chats(turns.unionByName(trap)), "chats")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return (chat.parse_chats(chats).withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars")))


def op9_bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    hits = bm25.top_k(docs, docs.where("doc_id % 20 = 0"), k=10)
    return hits.withColumn("score", F.round("score", 6))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    records = warc.resolved(warc.read_archives(spark, path, keep_payload=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs, size=20).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def _grafted(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) in which conversation c begins with the first h turns of c - c % 20 instead of its own,
    h being crc32(decimal c) % 4."""
    base = F.col("conv") - F.col("conv") % 20
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    convs = turns.select("conv").distinct()
    stems = turns.where((F.col("conv") % 20 == 0) & (F.col("i") < 3)).withColumnRenamed("conv", "base")
    length = stems.groupBy("base").agg(F.count(F.lit(1)).cast("int").alias("n_base"))
    n = length.count()
    own = (turns.join(hinted(length, n, 24), base == F.col("base"), "left").where(F.col("i") >= h)
           .withColumn("i", F.col("i") - h + F.least(h, F.coalesce("n_base", F.lit(0)))).select(turns.columns))
    heads = convs.join(hinted(stems, 3 * n, 64), base == F.col("base")).where(F.col("i") < h).select(turns.columns)
    return own.unionByName(heads), convs


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(trie.numbered_turns(read(spark, sf_dir, "conversations")), "turns")
    return trie.prefix_trie(*_grafted(turns))


def _with_period(doc_id: Column, text: Column) -> Column:
    """Texts of a tenth of the ids rewritten so that from some word on they repeat a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, "[ \\t-\\r]+", -1), lambda w: w != "")

    def rewritten(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.element_at(w, (a + F.pmod(i - a, p) + 1).cast("int")))), " ")

    # the words are bound once, as the only element of an array
    return F.when((h % 10 == 0) & (text.rlike("[^ \\t-\\r]")), F.transform(F.array(words), rewritten)[0]).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", _with_period(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, x: F.when(
        x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return (periodic.with_runs(docs).withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    sha(F.array_join(lines, "")).alias("runs_sha256"), sha(F.col("collapsed_text")).alias("collapsed_sha256")))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_feistel_shards, op3_near_dedup, op4_token_counts, op5_decontaminate, op6_quality, op7_language_id,
    op8_chat_format, op9_bm25_top_k, op10_warc, op11_substring_dedup, op12_prefix_trie, op13_periodic_runs)}


# ---- the same results in DuckDB SQL ----

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_words(breaks: str) -> str:
    return f"list_filter(string_split_regex({_LOWER}, '{breaks}'), lambda w: w <> '')"


_SPACES = "[\\x20\\x09-\\x0D]+"
_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _op1_sql() -> str:
    dims = ("source", "lang", "topic")
    ctes = [f"""d AS (SELECT doc_id, source, lang,
      CASE WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, 'icense') THEN 'licensed'
        WHEN contains(t, '%%%') OR contains(t, '###') OR contains(t, '$$$') THEN 'markup'
        WHEN contains(t, '@') THEN 'contact' ELSE 'prose' END AS topic,
      len(list_filter(string_split_regex(t, '{_SPACES}'), lambda w: w <> '')) AS n_tokens,
      CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
      FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
            "c AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)"]
    for k in dims:
        ctes.append(f"t_{k} AS (SELECT {k}, pow(sum(tokens), {MIX_POWER}) / sum(pow(sum(tokens), {MIX_POWER})) OVER () AS target_{k} "
                    f"FROM c GROUP BY {k})")
    ctes.append("r0 AS (SELECT c.*, tokens / sum(tokens) OVER () AS w, target_source, target_lang, target_topic FROM c "
                + " ".join(f"JOIN t_{k} ON c.{k} IS NOT DISTINCT FROM t_{k}.{k}" for k in dims) + ")")
    n = 0
    for _ in range(MIX_ROUNDS):
        for k in dims:
            ctes.append(f"r{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (w), CASE WHEN sum(w) OVER (PARTITION BY {k}) > 0 "
                        f"THEN w * target_{k} / sum(w) OVER (PARTITION BY {k}) ELSE 0.0 END AS w FROM r{n})")
            n += 1
    return f"""WITH {', '.join(ctes)},
p AS (SELECT source, lang, topic, round(w, 9) AS weight,
  round(coalesce(CASE WHEN tokens > 0 THEN w / tokens END
    / (SELECT max(CASE WHEN tokens > 0 THEN w / tokens END) FROM r{n}), 1.0), 9) AS probability FROM r{n})
SELECT doc_id, d.source, d.lang, d.topic, n_tokens, weight, probability, draw, draw < probability AS sampled
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic"""


_OP3_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_sql_words(_SPACES)} AS words FROM documents),
s AS (SELECT doc_id, CASE len(words) WHEN 0 THEN [] WHEN 1 THEN words
  ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles FROM w),
u AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c ON s.doc_id = c.x
"""

_OP5_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_sql_words(_WORDS)} AS words FROM benchmark),
spans AS (SELECT DISTINCT item, words[i:i + 9] AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
d AS (SELECT doc_id, {_sql_words(_WORDS)} AS words FROM documents),
grams AS (SELECT doc_id, n, i, words[i:i + n - 1] AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
    FROM d, (SELECT DISTINCT len(win) AS n FROM spans))),
hits AS (SELECT doc_id, n, i, item FROM grams JOIN spans USING (win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _sql_escaped(column: str) -> str:
    out = f"replace({column}, '&', '&amp;')"
    for mark, name in chat.ESCAPES:
        out = f"replace({out}, '{mark}', '{name}')"
    return out


_OP8_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
u AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) <> role, true) AS opens
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST({len(chat.BEGIN)} + sum(length({_sql_escaped("text")}) + CASE WHEN opens
    THEN {len(chat.OPEN) + len(chat.CLOSE) + len(chat.END)} + length({_sql_escaped("role")}) ELSE {len(chat.NEXT)} END) AS BIGINT)
    AS formatted_chars
FROM u GROUP BY conv_id
"""

_OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_sql_words(_WORDS)} AS words FROM documents),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
g AS (SELECT count(*) AS docs, avg(len(words)) AS mean_length FROM d),
f AS (SELECT term, ln(1 + ((SELECT docs FROM g) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM t GROUP BY term),
s AS (SELECT q.doc_id AS query_id, t.doc_id, round(sum(idf * t.tf * {bm25.K1 + 1}
    / (t.tf + {bm25.K1} * ({1 - bm25.B} + {bm25.B} * t.n / mean_length))), 9) AS score
  FROM t AS q JOIN t USING (term) JOIN f USING (term), g WHERE q.doc_id % 20 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10
"""

_OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to, 'ok' AS status
FROM q
"""

_OP11_SQL = f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}'), lambda w: w <> '') AS words
  FROM documents),
w AS (SELECT doc_id, i, words[i:i + 19] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d)),
r AS (SELECT doc_id, i, rank() OVER (PARTITION BY win ORDER BY doc_id, i) AS rank FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE rank > 1),
x AS (SELECT doc_id, words[p] AS word, p FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM x ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

# The reflected CRC-32 polynomial's remainders of four bits.
_CRC = [0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
        0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C]


def _sql_crc32(text: str) -> str:
    half = lambda c: f"xor(({c}) >> 4, {_CRC}[(({c}) & 15) + 1])"
    bits = (f"list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), "
            "lambda ch: ascii(ch)::BIGINT))")
    return f"xor(list_reduce({bits}, lambda crc, ch: {half(half('xor(crc, ch)'))}), 4294967295)"


_OP12_SQL = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations),
c AS (SELECT c, {_sql_crc32("CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
b AS (SELECT c.c, 0 AS part, t.i, role, text FROM c JOIN t ON t.c = c.c - c.c % 20 AND t.i <= h
  UNION ALL SELECT c.c, 1, t.i, role, text FROM c JOIN t ON t.c = c.c AND t.i > h),
n AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, role, text FROM b),
p AS (SELECT c, d, string_agg(role || chr(1) || text || chr(2), '') OVER (PARTITION BY c ORDER BY d) AS k,
    len(list_filter(string_split_regex(text, '{_SPACES}'), lambda w: w <> '')) AS words,
    d = max(d) OVER (PARTITION BY c) AS ends FROM n
  UNION ALL SELECT c, 0, '', 0, c NOT IN (SELECT c FROM n) FROM c),
nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
    bool_and(ends) AS leaf FROM p GROUP BY d, k),
sums AS (SELECT a.d, a.k, count(*) FILTER (y.d = a.d + 1) AS n_children, count(*) FILTER (y.leaf) AS n_leaves,
    CAST(sum((y.n_convs - 1) * y.words) AS BIGINT) AS saved_tokens
  FROM nodes y JOIN p a ON a.c = y.conv_id AND a.d <= y.d GROUP BY a.d, a.k)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs, n_children, n_leaves, saved_tokens,
  x.ends_sha256
FROM nodes x JOIN sums s ON s.d = x.d AND s.k = x.k
LEFT JOIN (SELECT p.c, p.d, m.conv_id FROM p JOIN nodes m ON m.d = p.d AND m.k = p.k) up ON up.c = x.conv_id AND up.d = x.d - 1
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": _op1_sql(), "op3_near_dedup": _OP3_SQL, "op5_decontaminate": _OP5_SQL, "op8_chat_format": _OP8_SQL,
    "op9_bm25_top_k": _OP9_SQL, "op10_warc": _OP10_SQL, "op11_substring_dedup": _OP11_SQL, "op12_prefix_trie": _OP12_SQL}
