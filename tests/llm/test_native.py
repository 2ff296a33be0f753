"""Mixing and decontamination: hard rows, brute force, plans without Python."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from skyroute.llm import decontaminate as dc
from skyroute.llm import mixing, queries
from tests.llm.conftest import SF


def _mix(df, **kw):
    return mixing.mix(df, {"source": F.col("source"), "lang": F.col("lang")}, mixing.n_tokens(F.col("text")), **kw)


def test_raked_weights_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    share = spark.createDataFrame([("en", 1.0), ("fr", 2.0), ("de", 1.0)], "lang string, share double")
    got = _mix(docs, rounds=40, targets={"lang": share}).toPandas()
    cells = got.drop_duplicates(["__source", "__lang"])
    by = cells.groupby("__lang")["__weight"].sum()
    assert by.get("es", 0) == 0 and abs(by["fr"] - 0.5) < 1e-3 and abs(by["en"] - 0.25) < 1e-3
    assert not got[(got["__lang"] == "es") & (got["__tokens"] > 0)]["__sampled"].any()
    assert got["__probability"].max() == 1.0
    kept = got[got["__sampled"]].groupby("__lang")["__tokens"].sum()
    assert abs(kept["fr"] / kept.sum() - 0.5) < 0.2


def test_budget_is_met_with_full_cells(spark):
    rows = [(i, s, n) for i, (s, n) in enumerate([("a", 1000), ("b", 400), ("c", 20), ("d", 3), ("e", 0)])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long")
    for keep in (0.0, 0.01, 0.3, 0.9, 1.0):
        got = mixing.mix(docs, {"source": F.col("source")}, F.col("n"), power=0.5, keep=keep).toPandas().set_index("source")
        p, ratio = got["__probability"], (got["__weight"] / got["n"]).dropna()
        assert abs((p * got["n"]).sum() - keep * 1423) < 1e-6 and abs(got["__rate"] - keep).max() < 1e-9
        assert p.between(0, 1).all() and p["e"] == 1
        part = [s for s in ratio.index if p[s] < 1]
        assert all(abs(p[x] / ratio[x] - p[y] / ratio[y]) <= 1e-4 * p[x] / ratio[x] for x in part for y in part)
    share = spark.createDataFrame([("b", 1.0), ("c", 1.0)], "source string, share double")
    got = mixing.mix(docs, {"source": F.col("source")}, F.col("n"), targets={"source": share}, keep=0.9).toPandas()
    assert dict(zip(got["source"], got["__probability"], strict=True)) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert abs(got["__rate"] - 420 / 1423).max() < 1e-9


def test_production_rounds_meet_correlated_targets(spark):
    rows = [(f"s{i}", f"l{j}", (4 ** i) * (99_900 if i == j else 100)) for i in range(5) for j in range(5)]
    docs = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "doc_id long, source string, lang string, n long")
    got = mixing.mix(docs, {"source": F.col("source"), "lang": F.col("lang")}, F.col("n"), power=queries.MIX_POWER,
                     rounds=queries.MIX_ROUNDS).toPandas()
    for d in ("source", "lang"):
        want = got.groupby(d)["n"].sum() ** queries.MIX_POWER
        assert (got.groupby(d)["__weight"].sum() / (want / want.sum()) - 1).abs().max() < 2e-4
    assert got["__residual"].max() <= mixing.TOLERANCE


def test_targets_that_cannot_be_met_are_told(spark):
    docs = spark.createDataFrame([(1, "a", "x", 10), (2, "b", "y", 10)], "doc_id long, source string, lang string, n long")
    share = [spark.createDataFrame([(v, 3.0), (w, 1.0)], "v string, share double") for v, w in ("ab", "yx")]
    with pytest.warns(UserWarning, match="off their targets"):
        got = mixing.mix(docs, {"source": F.col("source"), "lang": F.col("lang")}, F.col("n"), rounds=2,
                         targets={"source": share[0], "lang": share[1]}).toPandas()
    assert (got["__residual"] > 0.5).all() and list(got["__probability"].notna()) == [True, True]


def test_mix_hard_rows(hard_docs, no_docs):
    got = _mix(hard_docs).toPandas()
    assert len(got) == hard_docs.count() and list(got.columns[:7]) == hard_docs.columns
    assert got["__sampled"].notna().all()
    empty = got[got.doc_id.isin([2])]
    assert list(empty["__tokens"]) == [0] and list(empty["__probability"]) == [1.0]
    assert _mix(no_docs).count() == 0


@pytest.mark.parametrize("name", ["op1_mixing", "op5_decontaminate"])
def test_native_plans(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries.QUERIES[name](spark, SF).explain("formatted")
    assert not any(w in out.getvalue() for w in ("Python", "Pandas", "ArrowEval", "Cartesian", "NestedLoop"))


def _words(t):
    out, word = [], ""
    for c in (t or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out


def _brute(docs, items, size):
    windows = {}
    for name, text in items:
        w = _words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(name) if name is not None else "null")
    out = []
    for text in docs:
        w, hit, found = _words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[x]
        out.append((len(w), len(hit), sorted(found)))
    return out


ITEMS = [(10, "The cat, the CAT the cat the cat the cat the cat the cat"), (9, "zoé"), (None, "of of of"), (8, None),
         (7, "..."), (6, "one two three four five six seven eight nine ten eleven"), (6, "one two"),
         (5, "two three four five six seven eight nine ten eleven")]
TEXTS = [None, "", "!!", "the cat " * 9, "x the cat the cat", "ZOÉ zoé Zoé", "of of of of of", "one two one two three",
         "zero one two three four five six seven eight nine ten eleven twelve", "a " * 50 + "one two three four five six "
         "seven eight nine ten", "of of"]


def test_contamination_equals_brute_force(spark):
    docs = spark.createDataFrame([(i % 10, t, 1, "a") for i, t in enumerate(TEXTS * 2)],
                                 "doc_id long, text string, pos int, term string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.contamination(docs, items).collect()
    want = _brute(TEXTS * 2, ITEMS, 10)
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == sorted(
        (i % 10, *w) for i, w in enumerate(want))
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got)


def test_contamination_hard_rows(spark, hard_docs, no_docs):
    items = spark.createDataFrame([(1, "word5 zoé word6"), (2, "same row")], "item_id long, text string")
    got = {(r.doc_id, r.n_hit) for r in dc.contamination(hard_docs, items).collect()}
    assert (6, 2) in got and (None, 0) in got and (2, 0) in got and dict(got)[4] > 0
    assert dc.contamination(hard_docs, items.limit(0)).where("contaminated").count() == 0
    assert dc.contamination(no_docs, items).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "gamma x alpha y beta"), (2, "alpha " + "x " * 9 + "beta gamma"), (3, "alpha beta")],
                                 "doc_id long, text string")
    tests = dc.item_windows(spark.createDataFrame([(1, "alpha beta gamma")], "i long, t string"), "i", "t", 10)
    index = dc.build_index(docs, "doc_id", "text", tests)
    rows = {r.row: r.id for r in index.where("term_id = -1").collect()}
    assert {rows[r.row] for r in dc.proximity_matches(index, tests, 4).collect()} == {1}
    assert {rows[r.row] for r in dc.proximity_matches(index, tests, 12).collect()} == {1, 2}
    assert dc.phrase_matches(index, tests).count() == 0
