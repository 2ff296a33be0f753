"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
from collections import defaultdict

import pytest

from skyroute.llm import trie

TURNS = "conv_id long, turn long, role string, text string, extra string"


def brute(convs):
    """{conv: [(role, text), ...]} -> rows of the trie."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, m in members.items():
        if node:
            kids[node[:-1]] += 1
    for node, m in members.items():
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * words
            leaves[node[:d]] += not kids[node]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def found(spark, convs, empty=()):
    rows = [(c, t, role, text, "x") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    random.Random(0).shuffle(rows)
    turns = trie.numbered_turns(spark.createDataFrame(rows, TURNS))
    ids = spark.createDataFrame([(c,) for c in [*convs, *empty]], "conv long")
    got = trie.prefix_trie(turns, ids)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    return sorted(map(tuple, got.collect()))


def _convs(rng, n, deep):
    out, known = {}, [[]]
    for c in rng.sample(range(20_000), n):
        stem = rng.choice(known)
        turns = stem[:rng.randrange(len(stem) + 1)]
        for _ in range(rng.randrange(0, deep)):
            turns = [*turns, (rng.choice(["user", "assistant"]), rng.choice(["a", "a b", "", "c\td  e", "a b"]))]
        out[c] = turns
        known.append(turns)
    return out


@pytest.mark.parametrize(("single", "deep"), [(16, 5), (2, 9), (0, 12), (-1, 12)])
def test_equals_the_plain_dictionary(spark, monkeypatch, single, deep):
    """Peeled level by level, in stretches, and both."""
    monkeypatch.setattr(trie, "SINGLE", single)
    convs = _convs(random.Random(single), 80, deep)
    convs |= {30_000 + i: convs[next(iter(convs))] for i in range(20)}
    empty = [c for c, t in convs.items() if not t]
    assert found(spark, {c: t for c, t in convs.items() if t}, empty) == brute(convs)


def test_deep_conversations_share_most_turns(spark):
    """Hundreds of turns take a few rounds, also where two conversations part late."""
    long = [("user", f"t{i} w") for i in range(300)]
    convs = {1: long, 2: long[:290] + [("user", "else")], 3: long[:5], 4: [("assistant", "t0 w")], 9: long}
    assert len(trie._schedule(300)) < trie.SINGLE + 8
    assert found(spark, convs) == brute(convs)


def test_turn_order_and_missing_values(spark):
    rows = [(1, 2, "user", "c", "x"), (1, None, None, "a", "x"), (1, 1, "user", None, "x"), (None, 1, "user", "lost", "x"),
            (2, 5, "user", "b", "x"), (2, 5, "assistant", "b", "x"), (2, 5, "user", "b", "x")]
    turns = trie.numbered_turns(spark.createDataFrame(rows, TURNS))
    got = trie.prefix_trie(turns, turns.select("conv").distinct())
    want = brute({1: [("", "a"), ("user", ""), ("user", "c")], 2: [("assistant", "b"), ("user", "b"), ("user", "b")]})
    assert sorted(map(tuple, got.collect())) == want


def test_ids_of_one_node_in_many_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_BITS", 2)
    convs = {c: [("user", "same")] for c in range(0, 90, 3)}
    assert found(spark, convs) == brute(convs)


def test_empty(spark):
    turns = trie.numbered_turns(spark.createDataFrame([], TURNS))
    assert trie.prefix_trie(turns, turns.select("conv").distinct()).collect() == []
