"""Periodic runs against a plain search over all periods."""

import random
import time
import zlib

import pytest

from skyroute.llm import periodic, queries


def brute(t):
    out = []
    for q in range(1, len(t) // 3 + 1):
        i = q
        while i < len(t):
            if t[i] != t[i - q]:
                i += 1
                continue
            s = i - q
            while i < len(t) and t[i] == t[i - q]:
                i += 1
            n = i - s
            if n >= max(24, 3 * q) and not any(
                    q % p == 0 and all(t[x] == t[x - p] for x in range(s + p, s + n)) for p in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def online(t):
    c = periodic.Catchers()
    c.append_all(t)
    return c.close()


def hard_text(rng):
    t, most = [], rng.choice([30, 100, 400])
    while len(t) < most:
        kind, a = rng.random(), rng.choice([1, 2, 3, 5])
        if kind < .3:
            t += [rng.randrange(a) for _ in range(rng.randrange(1, 20))]
        elif kind < .6:
            t += [rng.randrange(a) for _ in range(rng.randrange(1, 30))] * rng.randrange(1, 9)
        elif kind < .8 and t:
            s = rng.randrange(len(t))
            t += t[s:s + rng.randrange(1, 120)] * rng.randrange(1, 5)
        else:
            x = rng.randrange(a)
            t += ([x] * rng.randrange(1, 60) + [7] + [x] * rng.randrange(1, 50) + [8]) * rng.randrange(1, 5)
    return t


@pytest.mark.parametrize("seed", range(4))
def test_online_runs_equal_the_plain_search(seed):
    rng, found = random.Random(seed), 0
    for _ in range(400):
        t = hard_text(rng)
        want = brute(t)
        found += len(want)
        assert online(t) == want
    assert found > 500


def test_online_means_that_prefixes_are_known():
    """Runs that ended inside a prefix are known when it has been read."""
    rng = random.Random(9)
    t = hard_text(rng) + [99] + hard_text(rng)
    c, known = periodic.Catchers(), []
    for i, w in enumerate(t):
        c.append_all([w])
        known.append(list(c.runs))
    for i, runs in enumerate(known):
        assert sorted(runs) == sorted(r for r in brute(t[:i + 2]) if r[0] + r[1] <= i)


@pytest.mark.parametrize("text", [[0] * 60_000, [i % 3000 for i in range(60_000)],
                                  ([0] * 6000 + [1] + [0] * 6000 + [2] + [0] * 5500 + [3]) * 3])
def test_long_repetitive_texts_take_seconds(text):
    began = time.time()
    runs = online(text)
    assert runs and time.time() - began < 20
    for s, n, q in runs:
        assert n >= max(24, 3 * q) and text[s:s + n - q] == text[s + q:s + n]


def test_frame(spark, hard_docs, no_docs):
    got = {r["doc_id"]: r for r in periodic.with_runs(hard_docs.withColumnRenamed("words", "runs")).collect()}
    assert [tuple(r) for r in got[4]["runs"]] == [(0, 80_000, 1954)]
    assert len(got[4]["collapsed_text"].split()) == 1954 and got[4]["shard"] == 1
    assert got[2]["runs"] == [] and got[2]["collapsed_text"] == "" and got[7]["collapsed_text"] == ""
    assert periodic.with_runs(no_docs).collect() == []


def test_pieces_of_a_text(monkeypatch):
    from skyroute.llm.words import word_lists

    text = (b"x y z " * 40) + b"end " + (b"q " * 30)
    whole = periodic.runs_of(word_lists(text))
    cut = periodic.runs_of(word_lists(text, 11))
    assert whole[0] == cut[0] == [(0, 120, 3), (121, 30, 1)]
    assert periodic.collapsed(*whole) == periodic.collapsed(*cut) == b"x y z end q"


def test_query_on_a_small_fixture(spark, tmp_path):
    """The whole query, rewriting included, against plain Python."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 400)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "a " * 50), (203, "\x1fa b " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    import hashlib
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rewritten = 0
    for i, text in rows:
        w = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            rewritten += 1
        runs = brute(w)
        gone = {x for s, m, q in runs for x in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode())
        assert r["collapsed_sha256"] == sha(b" ".join(x for k, x in enumerate(w) if k not in gone))
    assert rewritten > 5 and sum(r["n_runs"] for r in got.values()) > 5
