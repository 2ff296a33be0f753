"""The corpus pipeline, stage by stage, against plain Python."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from skyroute.llm import langid, mixing, sharding
from tests.llm.conftest import SF, table
from tests.llm.test_native import _brute
from tests.llm.test_near_dedup import _components


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = table("documents")
    text = dict(zip(rows.doc_id, rows.text, strict=True))
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]

    one = ids(cp.language_id(spark, docs, SF))
    assert sorted(one) == sorted(i for i, t in text.items() if any(c.isalpha() for c in t))  # clean texts stay
    two = ids(cp.near_duplicates(spark, docs, SF))
    assert sorted(two) == sorted(i for i, (_, c) in _components(list(text.items()), 5).items() if c == i)
    bench = table("benchmark")
    three = ids(cp.decontamination(spark, docs, SF))
    hit = _brute(list(text.values()), list(zip(bench.item_id, bench.text, strict=True)), 10)
    assert sorted(three) == sorted(i for i, h in zip(text, hit, strict=True) if not h[1])
    four = cp.mixture(spark, docs, SF)
    assert four.columns == docs.columns and 0 < four.count() < docs.count()
    last = cp.sharding_stage(spark, docs, SF).toPandas()
    assert len(last) == len(text)
    for n, i in enumerate(sorted(text)):
        r = last[last.doc_id == i].iloc[0]
        assert (r["shard"], r["slot"]) == sharding.locate(n, len(text), cp.SHARDS, cp.SEED)


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    key = ["doc_id", "shard", "slot"]
    assert sorted(map(tuple, cp.run(spark, SF).select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]


def test_hard_rows(spark, hard_docs, no_docs):
    for name, stage in cp.STAGES:
        got = stage(spark, hard_docs, SF)
        assert set(hard_docs.columns) <= set(got.columns)
        assert stage(spark, no_docs, SF).count() == 0
        if name == "near_duplicates":
            assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
        elif name != "mixture":
            assert got.count() == {"language_id": 7}.get(name, 10)


def test_a_tiny_cell_does_not_set_the_rate_of_the_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tiny = docs.limit(1).selectExpr("-1L doc_id", "'two words' text", "'xx' lang", "'own source' source", "9L n_chars")
    n = dict(docs.select("doc_id", mixing.n_tokens(F.col("text"))).collect()) | {-1: 2}
    kept = [{r.doc_id for r in cp.mixture(spark, d, SF).collect()} for d in (docs, docs.unionByName(tiny.to(docs.schema)))]
    share = [sum(n[i] for i in ids) / sum(n.values()) for ids in kept]
    assert all(abs(s - cp.MIX_KEEP) < 0.2 for s in share) and abs(share[0] - share[1]) < 0.02
    assert -1 in kept[1] and len(kept[0] ^ kept[1]) <= 0.02 * len(n)


def test_decisions_hold_for_rows_not_for_ids(spark):
    """Rows without an id, and texts that share one, are judged by themselves."""
    bench = table("benchmark")
    leak = "before it " + next(t for t in bench.text if len(t.split()) > 12) + " and after"
    a, b = (" ".join(f"{w}{i}" for i in range(40)) for w in ("one", "two"))
    rows = [(None, leak), (None, a), (None, "clean text"), (6, leak), (6, b), (7, a), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = lambda df: sorted(map(tuple, df.select("doc_id", "text").collect()), key=str)
    assert left(cp.decontamination(spark, docs, SF)) == sorted([r for r in rows if r[1] != leak], key=str)
    # of equal texts the row with the smallest id stays, one without an id last
    assert left(cp.near_duplicates(spark, docs, SF)) == sorted(
        [(None, "clean text"), (6, leak), (6, b), (7, a), (8, None), (8, None)], key=str)


def test_language_stage_follows_the_classifier(spark):
    from skyroute.llm import langid
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where("doc_id % 2 = 0"))
    alphabet = "".join(map(chr, range(0x430, 0x450)))
    russian = " ".join(alphabet[i:i + 3 + i % 5] + alphabet[31 - i:33] for i in range(28))
    junk = [russian, "qx zk", "\u4e2d\u6587", "\u00bd \u216b 12 %%", "Der " * 400,
            "TWFuIGlzIGRpc3Rpbmd1aXNoZWQsIG5vdCBvbmx5IGJ5IGhpcyByZWFzb24sIGJ1dCBieSB0aGlz" * 3]
    rows = spark.createDataFrame([(-i, t) for i, t in enumerate(junk, 1)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(rows)
    kept = {r.doc_id for r in langid.keep_identified(both, model).collect()}
    assert {i for i in kept if i < 0} == {-2, -3, -5}  # short ones and one word repeated are not judged
    held_out = {r.doc_id for r in docs.where("doc_id % 2 = 1").select("doc_id").collect()}
    assert held_out <= kept  # no clean held-out document is lost
    # with nothing to learn from, every text with a letter stays
    nothing = langid.fit(docs.where("false"))
    assert {r.doc_id for r in langid.keep_identified(both, nothing).collect()} == held_out | kept | {-1, -2, -3, -5, -6}


def test_numerals_are_no_letters():
    from skyroute.llm import langid
    assert not any(map(langid.has_letter, ["\u00bd \u00b2 \u216b \u2462 12 _", "", "%%%"]))
    assert all(map(langid.has_letter, ["\u00bda", "\u4e2d", "1 x", "\u00e9"]))


def test_decoding_equals_a_plain_loop(spark):
    """Language, score and ambiguity against loops over languages and bits."""
    import math

    from skyroute.llm import langid
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    texts = [r.text for r in docs.select("text").limit(40).collect()] + ["the", "la la", "x"]
    for margin in (0.05, 0.5):
        for t, (lang, score, unsure) in zip(texts, langid.decode(model, texts, margin), strict=True):
            x = langid.features(t)
            losses = []
            for c in range(len(model.languages)):
                loss = 0.0
                for b in range(model.code.shape[1]):
                    m = float(x @ model.coef[:, b] + model.bias[b]) * int(model.code[c, b])
                    loss += math.log1p(math.exp(-m)) * model.weights[c, b]
                losses.append(loss)
            best = min(range(len(losses)), key=losses.__getitem__)
            order = sorted(losses)
            assert lang == model.languages[best] and unsure == (order[1] - order[0] < margin)
            assert abs(score - 1 / sum(math.exp(-4 * (v - order[0])) for v in losses)) < 1e-5


def test_language_id_decodes_every_text(spark):
    texts = [(-1, "0123456789 " * 60), (-2, None), (-3, "".join(chr(0x4E00 + i * 7 % 5000) for i in range(400)))]
    clean = spark.read.parquet(f"{SF}/documents.parquet")
    docs = clean.select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    model = langid.fit(clean)
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    decoded = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert {i: found.pop(i) for i, _ in texts} == dict.fromkeys((-1, -2, -3), "und")
    assert len(set(found.values())) == len(model.languages) and all(decoded[i] == lang for i, lang in found.items())
    assert {r.doc_id for r in langid.keep_identified(docs, model).collect()} == set(found)
