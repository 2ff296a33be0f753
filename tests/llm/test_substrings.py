"""Substring dedup against a plain loop over all windows."""

import random

import pytest

from skyroute.llm import substrings
from skyroute.llm.words import word_lists


def brute(rows, size):
    """[(id, text)] -> {row: (words, removed, kept text)}, a window being a repeat if an equal one has a smaller id,
    or an earlier start under the same id (no id: the largest)."""
    key = lambda i: (i is None, i or 0)
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for s in range(len(w) - size + 1):
            g, at = tuple(w[s:s + size]), (key(i), s)
            first[g] = min(first.get(g, at), at)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s:s + size])] < (key(i), s):
                gone.update(range(s, s + size))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return out


def found(spark, rows, size):
    df = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), size)
    got = df.select("doc_id", "n_words", "n_removed", "kept_text", "removed").collect()
    for r in got:
        assert sum(x["end"] - x["begin"] for x in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["begin"] for a, b in zip(r["removed"], r["removed"][1:]))  # maximal: they never touch
    return sorted((tuple(r)[:4] for r in got), key=str)


def _texts(rng, n, words):
    shared = [" ".join(rng.choice("abc") for _ in range(12)) for _ in range(4)]
    out = []
    for _ in range(n):
        parts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, words))) for _ in range(3)]
        out.append(" ".join([parts[0], rng.choice(shared), parts[1], rng.choice(shared), parts[2]]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_plain_loop(spark, monkeypatch, seed):
    rng = random.Random(seed)
    texts = _texts(rng, 60, 25)
    texts += texts[:20] + ["a " * 40, None, "", " \n ", "a b"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    for size in (2, 5, 20):
        assert found(spark, rows, size) == sorted(brute(rows, size), key=str)


def test_blocks_and_pieces(monkeypatch):
    """Repeats inside a block leave as ranges; cutting texts and blocks anywhere changes nothing."""
    import numpy as np

    from skyroute.llm.common import WordHashes

    rng = random.Random(3)
    text = " ".join(rng.choice("ab") for _ in range(400)).encode()
    assert [w for x in word_lists(text, 7) for w in x] == text.split()
    monkeypatch.setattr(substrings, "word_lists", lambda t: word_lists(t, 9))
    parts = list(substrings._segments(text, 5, WordHashes()))
    windows = substrings.Windows(5)
    starts = np.concatenate([np.arange(f, f + len(h) - 4) for f, h in parts])
    assert starts.tolist() == list(range(396))
    cut = np.concatenate([windows.hashes(h)[0] for _, h in parts])
    words = text.split()
    by_text = {}
    for s, h in zip(starts, cut, strict=True):
        assert by_text.setdefault(tuple(words[s:s + 5]), h) == h
    assert len(set(by_text.values())) == len(by_text)


def test_repeated_and_missing_ids(spark):
    t = " ".join(f"w{i}" for i in range(30))
    rows = [(None, t), (None, "x " + t), (5, t), (5, t), (5, "y " + t), (7, "z " + t), (2, None), (2, None)]
    assert found(spark, rows, 20) == sorted(brute(rows, 20), key=str)


def test_hard_rows(spark, hard_docs, no_docs):
    got = substrings.without_repeats(hard_docs.withColumnRenamed("shard", "n_words"), 20)
    assert got.columns.count("n_words") == 1 and {"words", "n_removed", "kept_text"} <= set(got.columns)
    by_id = {r["doc_id"]: r for r in got.collect()}
    # the long text repeats with a period of 977 pairs of words: only its first period stays
    assert by_id[4]["n_words"] == 80_000 and by_id[4]["n_words"] - by_id[4]["n_removed"] == 1954
    assert by_id[5]["n_removed"] == 80_000 and by_id[5]["kept_text"] == ""
    assert by_id[2]["n_words"] == 0 and by_id[8]["kept_text"].startswith("<|endoftext|> 12 %%%")
    assert substrings.without_repeats(no_docs).collect() == []
    with pytest.raises(ValueError, match="integers"):
        substrings.without_repeats(hard_docs.selectExpr("cast(doc_id as string) doc_id", "text"))
