"""Token counts, shards, chats and archives against brute force and round trips."""

import gzip
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyroute.llm import chat, queries, sharding, token_counts, warc
from tests.llm.conftest import SF, table


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in queries.op4_token_counts(spark, SF).collect()}
    docs = table("documents")
    assert len(got) == len(docs)
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        n = len(tok.encode(t, add_special_tokens=False))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(t.encode()), n > 1024)


ODD = ["", " ", "  a  b ", "it's  we'll\n\n x", "a <|endoftext|> b", "a  <|endoftext|>  b", "  x 　 y  z",
       "x" * 300 + " " + "é" * 90, "1 22  333\t\t4 \n 5", "\U0001f600 \U0001f600", " \n a", "tab\t x"]


def test_cut_texts_count_as_whole_ones():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    odd = ODD + [a + b for a in ODD for b in ODD]
    assert token_counts.counter(path)(odd) == [len(tok.encode(t, add_special_tokens=False)) for t in odd]


def test_parts_are_bounded_and_count_as_whole_ones(monkeypatch):
    """Texts without spaces are cut at punctuation, texts with special strings elsewhere; groups of few bytes."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    added = token_counts.marks(path)
    monkeypatch.setattr(token_counts, "LONG_CHARS", 20)
    cjk = "\u4eca\u65e5\u306f\u3001\u4e16\u754c\u3002abc,DEF.\uac00\ub098\uff01\uff1f" * 40
    texts = [cjk, cjk + " " + cjk, "it's,he'll.x!" * 9, "a.b(c)d:e;f" * 9 + "<|endoftext|>", "one two <|endoftext|>  three " * 5,
             " <|endoftext|> " + cjk, "x <|endoftext|><|endoftext|> y", "w." * 30 + "\n" + "\u00e9,\u00e9." * 30]
    for limit in (1, 50, 1 << 20):
        assert token_counts.counter(path, limit)(texts) == [len(tok.encode(t, add_special_tokens=False)) for t in texts]
    for t in texts:
        assert "".join(token_counts.parts_of(t, added)) == t
    assert max(map(len, token_counts.parts_of(cjk, added))) < 20
    assert len(token_counts.parts_of("one two <|endoftext|> three four five", added)) == 4


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    path = queries.tokenizer_path(name)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path).collect()}
    assert got == dict(enumerate(token_counts._encoder(path)(ODD)))


def test_token_counts_hard_rows(hard_docs, no_docs):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    got = token_counts.count_tokens(hard_docs, path)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert got.count() == hard_docs.count()
    assert {r.n_tokens for r in got.where("doc_id in (2, 3)").collect()} == {0}
    assert token_counts.count_tokens(no_docs, path).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 24, 25, 1000, 4097])
def test_permutation_is_a_bijection(n):
    p = sharding.Permutation(n, 7)
    x = np.arange(n)
    y = p.forward(x)
    assert sorted(y) == list(x) and list(p.inverse(y)) == list(x)


def test_shards_follow_the_law(spark):
    got = queries.op2_feistel_shards(spark, SF).toPandas()
    docs = table("documents").sort_values("doc_id").reset_index(drop=True)
    assert sorted(got.doc_id) == list(docs.doc_id) and set(got.law) == {"rows"}
    per = got.groupby("shard").slot.agg(["size", "min", "max"])
    assert set(per.index) == set(range(24)) and per["size"].max() - per["size"].min() <= 1
    assert (per["min"] == 0).all() and (per["max"] == per["size"] - 1).all()
    by = got.set_index("doc_id")
    for row, d in docs.iterrows():
        raw = d.text.encode()
        want = (len(raw) + 8, zlib.crc32(raw), *sharding.locate(row, len(docs), 24, queries.SEED))
        g = by.loc[d.doc_id]
        assert (g["size"], g.text_crc32, g.shard, g.slot) == want
        assert sharding.row_at(int(g.shard), int(g.slot), len(docs), 24, queries.SEED) == row


def test_shards_hard_rows(hard_docs, no_docs):
    a = sharding.shard_rows(hard_docs, ["doc_id"], 3, 1).toPandas()
    b = sharding.shard_rows(hard_docs.repartition(5), ["doc_id"], 3, 1).toPandas()
    assert list(a.columns) == ["doc_id", "text", "lang", "source", "n_chars", "words", "shard", "slot"]
    key = ["shard", "slot", "doc_id"]
    assert a.sort_values(key)[key].reset_index(drop=True).equals(b.sort_values(key)[key].reset_index(drop=True))
    assert a[["shard", "slot"]].drop_duplicates().shape[0] == len(a) == 10
    assert sharding.shard_rows(no_docs, ["doc_id"], 3, 1).count() == 0


def _chat_digest(rows):
    told = "".join(f"{r}\n{t}\n" for r, t in rows)
    return hashlib.sha256(told.encode()).hexdigest()


def test_chats_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.execute(queries.ORACLE_SQL["op8_chat_format"]).df().sort_values("conv_id").reset_index(drop=True)
    got = queries.op8_chat_format(spark, SF).toPandas().sort_values("conv_id").reset_index(drop=True)
    assert got[list(want.columns)].astype(str).equals(want.astype(str))
    last = got[got.conv_id == -1].iloc[0]
    text = "</s>[INST] ok [/INST]"
    assert last.turns_sha256 == _chat_digest([("user", text), ("assistant", text)])
    assert (last.loss_chars, last.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_chats_hard_rows(spark):
    bad = ["<|user|>\n", "&amp;&lt;", "<s>&bos;</s>", "<|+|>", "[INST]<", "|>", "", "é\U0001f600", "<|", "a</s", ">"]
    rows = [(1, i, "assistant" if i % 3 else "<|x|>\n", t, 7) for i, t in enumerate(bad)]
    rows += [(None, 0, None, None, 1), (None, None, "user", "x", 1), (2, 1, "a", "same", 1), (2, 1, "a", "same", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat.parse_chats(chat.format_chats(df)).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3]) for r in rows[:len(bad)]]
    assert got[1].loss == "".join(r[3] for r in rows[:len(bad)] if r[2] == "assistant")
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "x"), ("", "")]
    assert [(t.role, t.text) for t in got[2].turns] == [("a", "same")] * 2
    assert got[2].formatted == "<s><|a|>\nsame<|+|>same</s>"
    assert chat.parse_chats(chat.format_chats(df.limit(0))).count() == 0


def test_long_conversations_take_seconds(spark):
    """Messages, spans and masked text of tens of thousands of turns; chunk borders change nothing."""
    import time

    def turns(n, run):
        return [("assistant" if i // run % 2 else "user", f"é{i} <s> " + "&" * (i % 3)) for i in range(n)]
    chats = {1: turns(30_000, 1), 2: turns(30_000, 700), 3: turns(257, 1), 4: turns(1, 1), 5: turns(256, 300)}
    rows = [(c, i, r, t) for c, x in chats.items() for i, (r, t) in enumerate(x)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4, "conv_id")
    began = time.time()
    out = chat.parse_chats(chat.format_chats(df)).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in out.collect()}
    assert time.time() - began < 60
    for c, x in chats.items():
        assert [(t.role, t.text) for t in got[c].turns] == x
        assert got[c].loss == "".join(t for r, t in x if r == "assistant")
    assert got[2].formatted.count(chat.OPEN) - got[2].formatted.count(chat.NEXT) == -(-30_000 // 700)


def test_warc_round_trip(spark):
    got = {r.page_id: r for r in queries.op10_warc(spark, SF).collect()}
    pages = table("pages")
    first = {}
    for i, h in sorted(zip(pages.page_id, pages.html, strict=True)):
        first.setdefault(h, i)
    assert len(got) == len(pages)
    for i, h in zip(pages.page_id, pages.html, strict=True):
        raw, g = h.encode(), got[i]
        revisit = len(raw) >= 100 and first[h] != i
        assert (g.payload_bytes, g.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (g.record_type, g.refers_to) == (("revisit", first[h]) if revisit else ("response", None))


def test_warc_hard_rows(spark, tmp_path):
    big = "é\r\n\r\nWARC/1.1\r\n0\r\n" * 9000
    rows = [(1, "http://a\r\nX: y", big, "x"), (2, None, big, "x"), (3, "u", None, "x"), (4, "u", "", "x"),
            (5, "u", "short", "x"), (6, "u", "short", "x"), (None, "u", "n" * 200, "x"), (7, "u", "t" * 100, "x"),
            (7, "u", "t" * 100, "x"), (8, "u", "t" * 100, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    warc.write_archives(df, f"{tmp_path}/a", segment_bytes=1000, chunk_bytes=77)
    got = warc.resolved(warc.read_archives(spark, f"{tmp_path}/a")).collect()
    assert len(got) == len(rows) and {r.status for r in got} == {"ok"}
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    assert bytes(by[1][0].payload).decode() == big and by[2][0].refers_to == 1
    assert by[2][0].payload_digest == by[1][0].payload_digest and by[2][0].payload_bytes == len(big.encode())
    assert [(r.record_type, r.refers_to) for r in by[7]] == [("response", None)] * 2 and by[8][0].refers_to == 7
    assert by[3][0].payload_bytes == by[4][0].payload_bytes == 0 and by[6][0].record_type == "response"
    assert by[None][0].record_type == "response"
    warc.write_archives(df.limit(0), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").count() == 0


def test_warc_faults(spark, tmp_path):
    recs = list(warc.page_records(1, "u", b"p" * 5000, "d", None, 0, "2000-01-01T00:00:00Z", 1000, 100))
    broken = warc._head("response", "urn:x", "d", 20, X_Page_ID=2) + b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz"
    broken = broken.replace(b"Content-Length: 20", b"Content-Length: %d" % (len(broken) - broken.index(b"HTTP")))
    (tmp_path / "x.gz").write_bytes(gzip.compress(b"".join(r + warc.RECORD_END for r in recs[:2] + recs[3:] + [broken])))
    got = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "x.gz")).collect()}
    assert (got[1].status, got[1].payload) == ("incomplete", None) and got[2].status == "framing"


def test_warc_leaves_out_other_records_and_reports_broken_tails(spark, tmp_path):
    """warcinfo and request records are no responses; what comes before a cut or damaged place counts."""
    record = lambda kind, n, **f: warc._head(kind, f"urn:{n}", "d", 6, **f) + b"A: b\r\n" + warc.RECORD_END
    pages = [b"".join(r + warc.RECORD_END for r in warc.page_records(
        i, "u", b"payload" * 40, "d", None, 0, "2000-01-01T00:00:00Z", 1 << 15, 100)) for i in range(6)]
    (tmp_path / "foreign.warc").write_bytes(record("warcinfo", 1) + pages[0] + record("request", 2) + pages[1])
    (tmp_path / "members.gz").write_bytes(b"".join(map(gzip.compress, [record("metadata", 3), pages[2], pages[3]])))
    cut = gzip.compress(pages[4] + pages[5])
    (tmp_path / "cut.gz").write_bytes(cut[:-20])
    (tmp_path / "damaged.warc").write_bytes(pages[5].replace(b"X-Page-ID: 5", b"X-Page-ID: 6") + b"WARC/1.1\r\nno length\r\n\r\nx")
    segments = list(warc.page_records(9, "u", b"z" * 900, "d", None, 0, "2000-01-01T00:00:00Z", 400, 100))
    other = [segments[0].replace(b"WARC-Type: response", b"WARC-Type: resource"), *segments[1:]]
    (tmp_path / "resource.warc").write_bytes(b"".join(r + warc.RECORD_END for r in other))
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in got if r.status == "ok") == [0, 1, 2, 3, 4, 6]
    assert {r.record_type for r in got if r.status == "ok"} == {"response"}
    assert sorted((r.status, r.page_id) for r in got if r.status != "ok") == [("broken", None), ("broken", None)]
