"""Near-duplicates and BM25 against brute force."""

import math
import random
import tracemalloc

import numpy as np
import pytest

from skyroute.llm import bm25, near_dedup, queries
from tests.llm.conftest import SF, table


def _components(docs, k, percent=80):
    """(id -> set size, smallest reachable id) by comparing all pairs."""
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def _check(spark, docs, k):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, k=k).collect()}
    assert got == _components(docs, k)


def test_whole_table(spark):
    got = {r.doc_id: r for r in queries.op3_near_dedup(spark, SF).collect()}
    docs = table("documents")
    want = _components(list(zip(docs.doc_id, docs.text, strict=True)), 2)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize("k, block, size", [(2, 4096, 1 << 25), (5, 4096, 1 << 25), (2, 20, 1 << 25), (2, 4096, 9000)])
def test_large_groups_of_near_copies(spark, monkeypatch, k, block, size):
    """One family whose members are often less alike than 0.8 to each other, chains, and copies; buckets of one
    block, and of many by rows or by bytes."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", size)
    rng = random.Random(k)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = []
    for i in range(150):
        w = list(base)
        for j in rng.sample(range(len(w)), rng.randrange(1, 12)):
            w[j] = f"x{rng.randrange(10**6)}"
        docs.append((1000 - i, " ".join(w)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(30):
        chain[rng.randrange(100)] = f"n{i}"
        docs.append((2000 + i, "  ".join(chain).upper()))
    docs += [(3000 + i, "exactly the same text for all of these") for i in range(60)]
    docs += [(4000 + i, f"alone {rng.random()} {rng.random()} {rng.random()}") for i in range(60)]
    _check(spark, docs, k)


def test_edges_of_the_threshold(spark):
    a = [f"a{i}" for i in range(10)]
    docs = [(1, " ".join(a)), (2, " ".join(a[:9])), (3, " ".join(a[:8])), (4, " ".join(a[:7])), (5, "one"), (6, "ONE\n"),
            (7, "one two"), (8, ""), (9, None), (10, " \t"), (11, "É e"), (12, "é e")]
    _check(spark, docs, 2)


def test_near_dedup_hard_rows(hard_docs, no_docs):
    got = near_dedup.near_duplicates(hard_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = {(r.doc_id, r.component_id, r.kept) for r in got.collect()}
    assert got.count() == hard_docs.count()
    assert {(4, 4, True), (5, 4, False), (None, None, True), (2, 2, True), (3, 3, True), (7, 7, True), (6, 6, True)} <= rows
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_least_matches():
    need = near_dedup.least_matches([50, 100, 250], 0.8, 1e-6)
    assert 0 < need[0] < 40 and need[0] * 2 < need[1] < 80 and need[2] < 200
    assert near_dedup.least_matches([50], 0.8, 0.5)[0] > need[0]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (300, 200)]
    got = {r.id: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 300: 200, 200: 200}


def _bm25(docs, queries_, k):
    words = [(i, bm25.terms(t.encode())) for i, t in docs if t is not None and i is not None or t is None]
    n = len(words)
    mean = sum(len(w) for _, w in words) / n
    df, tf = {}, []
    for _, w in words:
        c = dict(zip(*(x.tolist() for x in np.unique(w, return_counts=True)), strict=True))
        tf.append(c)
        for t in c:
            df[t] = df.get(t, 0) + 1
    out = {}
    for q, text in queries_:
        hits = []
        for (i, w), c in zip(words, tf, strict=True):
            s = sum(math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * (bm25.K1 + 1)
                    / (c[t] + bm25.K1 * (1 - bm25.B + bm25.B * len(w) / mean))
                    for t in set(bm25.terms((text or "").encode()).tolist()) if t in c)
            if s > 0:
                hits.append((-round(s, 9), i))
        out[q] = sorted(hits)[:k]
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 30, 30_000])
def test_bm25_equals_brute_force(spark, shard_bytes):
    docs = table("documents")
    rows = list(zip(docs.doc_id, docs.text, strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in bm25.top_k(df, df.where("doc_id % 20 = 0"), k=7, shard_bytes=shard_bytes).collect():
        got.setdefault(r.query_id, []).append((r.rank, -round(r.score, 6), r.doc_id))
    want = _bm25(rows, [r for r in rows if r[0] % 20 == 0], 7)
    assert set(got) == set(want)
    for q, hits in want.items():
        assert sorted(got[q]) == [(n + 1, round(s, 6), i) for n, (s, i) in enumerate(hits)]


def test_bm25_skips_blocks_and_loses_nothing():
    """Alike documents lie in one range: ranges that cannot reach the k best are never read."""
    rng = np.random.default_rng(4)
    topics = [[f"t{t}w{w}" for w in range(40)] for t in range(12)]
    texts = [f"topic{t} topic{t} topic{t} " + " ".join(rng.choice(topics[t], 25)) + " the of and" for t in rng.integers(0, 12, 3000)]
    index = bm25.Shard(31.0)
    for i, t in enumerate(texts):
        index.add(i, t.encode())
    plain = index.build().stored()
    index = bm25.Shard.load(plain[0].values)
    df = np.diff(index.starts)
    idf = dict(zip(index.keys.tolist(), np.log1p((3000 - df + 0.5) / (df + 0.5)), strict=True))
    for text in texts[:40]:
        keys = np.unique(bm25.terms(text.encode()))
        weights = np.array([idf[x] for x in keys.tolist()])
        sums = np.zeros(3000)
        for key, w in zip(keys, weights, strict=True):
            t = np.searchsorted(index.keys, key)
            at = slice(index.starts[t], index.starts[t + 1])
            sums[index.docs[at]] += w * index.impacts[at]
        sums = np.round(sums, 9)
        best = np.lexsort((index.ids, -sums))[:9]
        ids, scores = index.search(keys, weights, 9)
        assert ids.tolist() == index.ids[best].tolist() and scores.tolist() == sums[best].tolist()
    assert index.read < 0.5 * index.listed


def test_bm25_a_full_shard_takes_little_memory(monkeypatch):
    """Documents of 3,500 bytes and 500 words: what a worker holds while it makes, opens and searches an index."""
    rng = np.random.default_rng(6)
    monkeypatch.setattr(bm25, "terms", lambda text: rng.zipf(1.2, 500).astype(np.uint64) % np.uint64(300_007))
    tracemalloc.start()
    index = bm25.Shard(500.0)
    for i in range(bm25.SHARD_BYTES // 3500):
        index.add(i, b"")
    index = bm25.Shard.load(index.build().stored()[0].values)
    keys = np.unique(bm25.terms(b""))
    ids, _ = index.search(keys, np.ones(len(keys)), 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids) == 10 and peak < 110e6


def test_bm25_several_shards_and_queries_share_thresholds():
    """Queries searched together over two shards find what one index finds, and skip blocks of the second shard."""
    rng = np.random.default_rng(5)
    texts = [f"topic{t} " + " ".join(rng.choice([f"t{t}w{w}" for w in range(60)], 30)) + " the of and" for t in rng.integers(0, 9, 3000)]
    rows = [(int(i), t) for i, t in zip(rng.permutation(3000) // 2, texts, strict=True)]
    parts = [rows, rows[:1500], rows[1500:]]
    built = []
    for part in parts:
        index = bm25.Shard(34.0)
        for i, t in part:
            index.add(i, t.encode())
        built.append(bm25.Shard.load(index.build().stored()[0].values))
    one, *both = built
    asked = []
    for text in [*texts[:150], "", "nowhere", "topic3", texts[0]]:
        keys = np.unique(bm25.terms(text.encode()))
        asked.append((keys, rng.uniform(1, 6, len(keys))))
    best = bm25.Best(len(asked), 7)
    for shard in both:
        shard.search_all(asked, best)
    for q, (keys, weights) in enumerate(asked):
        ids, scores = one.search(keys, weights, 7)
        assert best.ids[best.queries == q].tolist() == ids.tolist()
        assert np.allclose(best.scores[best.queries == q], scores, rtol=0, atol=2e-9)
    alone = bm25.Shard.load(both[1].stored()[0].values)
    alone.search_all(asked, bm25.Best(len(asked), 7))
    assert both[1].read <= alone.read


def test_bm25_matrices_are_as_wide_as_their_ranges():
    """Full blocks take no room for documents that their range does not have, and searches by them lose nothing."""
    rng = np.random.default_rng(8)
    sizes = (700, 40, 35, 90, 300)
    texts = [f"head{t} head{t} head{t} " + " ".join(rng.choice([f"w{w}" for w in range(90)], 40)) for t, n in enumerate(sizes) for _ in range(n)]
    index = bm25.Shard(43.0)
    for i, t in enumerate(texts):
        index.add(i, t.encode())
    index = bm25.Shard.load(index.build().stored()[0].values)
    widths = np.diff(index.opens)
    assert widths.sum() == len(texts) and len(set(widths.tolist())) > 2
    assert [m.shape[1] for m in index.matrices if len(m)] == [w for m, w in zip(index.matrices, widths.tolist(), strict=True) if len(m)]
    assert any(len(m) for m in index.matrices)
    asked, queries = [], [*texts[::50], "head1", "nowhere"]
    for text in queries:
        keys = np.unique(bm25.terms(text.encode()))
        asked.append((keys, rng.uniform(1, 6, len(keys))))
    best = bm25.Best(len(asked), 5)
    index.search_all(asked, best)
    for q, (keys, weights) in enumerate(asked):
        sums = np.zeros(len(texts))
        for key, w in zip(keys, weights, strict=True):
            t = np.flatnonzero(index.keys == key)
            at = slice(index.starts[t[0]], index.starts[t[0] + 1]) if len(t) else slice(0)
            sums[index.docs[at]] += w * index.impacts[at]
        sums = np.round(sums, 9)
        order = np.lexsort((index.ids, -sums))[:5]
        order = order[sums[order] > 0]
        assert best.ids[best.queries == q].tolist() == index.ids[order].tolist()
        assert np.allclose(best.scores[best.queries == q], sums[order], rtol=0, atol=2e-9)


def test_bm25_ids_are_integers(hard_docs):
    text_ids = hard_docs.selectExpr("cast(doc_id as string) doc_id", "text")
    with pytest.raises(ValueError, match="integers"):
        bm25.top_k(text_ids, text_ids)


def test_bm25_hard_rows(hard_docs, no_docs):
    hits = bm25.top_k(hard_docs, hard_docs, k=3, shard_bytes=300_000).collect()
    by = {}
    for r in sorted(hits, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.doc_id)
    assert set(by) == {1, 4, 5, 6, 8} and by[6][:2] == [6, 6] and by[4][:2] == [4, 5]
    assert bm25.top_k(no_docs, no_docs).count() == 0 and bm25.top_k(hard_docs, no_docs).count() == 0
