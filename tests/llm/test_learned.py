"""Language ID and quality: held-out accuracy, identities, hard rows."""

import zlib

import numpy as np
import pytest

from skyroute.llm import langid, quality, queries
from tests.llm.conftest import table

SF_MID = "/root/testdata/sf0.01"


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_language_accuracy(spark):
    got = queries.op7_language_id(spark, SF_MID).toPandas().set_index("doc_id")
    docs = table("documents", SF_MID).set_index("doc_id")
    assert len(got) == len(docs) and all(got.held_out[i] == held_out(i) for i in got.index)
    own = got[got.held_out].join(docs)
    assert (own.lang_pred == own.lang).mean() > 0.95
    assert got.score.between(0, 1).all() and set(got.lang_pred) <= {"en", "fr", "de", "es", "und"}


def test_language_hard_rows(spark, hard_docs, no_docs):
    model = langid.fit(hard_docs)
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(hard_docs, model).collect()}
    assert {(2, "und"), (3, "und"), (7, "und")} <= got and (4, "fr") in got
    kept = langid.keep_identified(hard_docs, model)
    assert kept.columns == hard_docs.columns and kept.count() == 7
    none = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.predict(hard_docs, none).collect()} == {"und"}
    assert langid.predict(no_docs, model).count() == 0
    one = langid.fit(hard_docs.where("lang = 'en'"))
    assert langid.decode(one, ["abc", "1 2", None], 0.1) == [("en", 1.0, False), ("und", 0.0, False), ("und", 0.0, False)]


@pytest.mark.parametrize("k", [2, 3, 4, 9, 40])
def test_codewords_are_apart(k):
    code = langid.codewords(k, 1).astype(int)
    apart = (code.shape[1] - code @ code.T) // 2 + code.shape[1] * np.eye(k, dtype=int)
    assert code.shape[0] == k and apart.min() >= (1 if k < 3 else 2) and (np.abs(code.sum(axis=0)) < k).all()


def test_features_do_not_depend_on_the_block():
    t = "Zoé abc, 123 " * 700
    assert np.array_equal(langid.features(t), langid.features(t, 64))


def _auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = label == 1
    return (rank[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


def test_quality_held_out(spark):
    got = queries.op6_quality(spark, SF_MID).toPandas().set_index("doc_id")
    docs, labels = table("documents", SF_MID), table("labels", SF_MID).set_index("doc_id")
    assert len(got) == len(docs) and all(got.held_out[i] == held_out(i) for i in got.index)
    own = got[got.held_out].join(labels, how="inner")
    assert _auc(own.score.to_numpy(), own.quality.to_numpy()) > 0.9
    assert (own.predicted == own.quality).mean() > 0.85
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()


def test_pair_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    size = quality.WORD_BUCKETS + quality.N_DENSE
    m = quality.Machine(np.zeros(quality.N_DENSE), np.ones(quality.N_DENSE), 0.3, rng.normal(size=size),
                        rng.normal(size=(size, 4)))
    item = quality.features("some words and some more words", 30)
    ids, x, starts = m.rows([item])
    want = m.bias + (m.linear[ids] * x).sum() + sum(
        m.factors[ids[i]] @ m.factors[ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i))
    assert abs(m.sums(ids, x, starts)[0][0] - want) < 1e-9


def test_quality_hard_rows(spark, hard_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, 1), (None, 1), (3, None)], "doc_id long, quality int")
    m = quality.fit(hard_docs, labels)
    got = quality.score(hard_docs, m).collect()
    assert len(got) == hard_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score(no_docs, m).count() == 0
    none = quality.fit(hard_docs, labels.limit(0))
    assert {r.score for r in quality.score(hard_docs, none).collect()} == {0.5}
