"""Quality classifier: a factorisation machine over words, structure and metadata.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j). The pair term is
computed in time linear in the number of features as
0.5 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features: hashed words (log counts, unit length), structure of the whole text (sizes,
shares of character classes, repeated lines and words) and the table's stated length.
Labels, language, source and id are no features. The model is fitted on a bounded sample
of labelled rows, ``max_rows`` with the smallest hashes of their ids.

Cases: null and empty texts are scored from their structure; a null length is a missing
value; without labels of both kinds the score is the share of label 1 (0.5 without any);
repeated rows are scored each; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BUCKETS = 1 << 14
KEPT_WORDS = 500_000
#: Character classes: lower, upper, digit, space, line break, sentence marks, other ASCII, non-ASCII.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[:128] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 0, 1, 2, 3, 4
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 5
N_DENSE = 16


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        b = self[word] = xxhash.xxh3_64_intdigest(word) % WORD_BUCKETS
        return b


_bucket = _Buckets()


def features(text: str | None, stated: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, their values, dense features) of one text."""
    raw = (text or "").encode()
    words = raw.lower().split()
    lines = raw.split(b"\n")
    n = max(1, len(raw))
    classes = np.zeros(8)
    for i in range(0, len(raw), 1 << 20):
        classes += np.bincount(_CLASS[np.frombuffer(raw, np.uint8, min(1 << 20, len(raw) - i), i)], minlength=8)
    at, count = np.unique(np.fromiter(map(_bucket.__getitem__, words), np.int32, len(words)), return_counts=True)
    value = np.log1p(count)
    value /= max(1e-9, np.sqrt((value**2).sum()))
    dense = [np.log1p(len(raw)), np.log1p(len(words)), len(raw) / (1 + len(words)) / 8,
             len(set(lines)) / len(lines), len(lines) * 50 / n, len(at) / max(1, len(words)),
             *np.sqrt(classes / n), 0.0 if stated is None else np.log1p(max(0, stated)), float(stated is None)]
    return at, value, np.array(dense)


@dataclass
class Machine:
    """Weights over the word buckets followed by the dense features."""

    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows(self, items: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Concatenated (feature ids, values) and where each row starts."""
        ids, values, starts, at = [], [], [], 0
        own = np.arange(WORD_BUCKETS, WORD_BUCKETS + N_DENSE)
        for i, v, d in items:
            ids += [i, own]
            values += [v, np.clip((d - self.mean) / self.scale, -4, 4) / 4]
            starts.append(at)
            at += len(i) + N_DENSE
        return np.concatenate(ids), np.concatenate(values), np.array(starts)

    def sums(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores by the sum-of-squares identity, and the sums of v_if x_i."""
        vx = self.factors[ids] * x[:, None]
        s = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * (s**2 - np.add.reduceat(vx**2, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.linear[ids] * x, starts) + pairs, s

    def scores(self, items: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(*self.rows(items))[0], -30, 30)))


def _train(items: list, labels: np.ndarray, rank: int, epochs: int, rate: float, l2: float, seed: int) -> Machine:
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    size = WORD_BUCKETS + N_DENSE
    start = np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6)))
    none = Machine(np.zeros(N_DENSE), np.ones(N_DENSE), start, np.zeros(size), np.zeros((size, rank)))
    if share in (0.0, 1.0) or not len(labels):
        return none
    dense = np.array([d for _, _, d in items])
    m = Machine(dense.mean(axis=0), dense.std(axis=0) + 1e-6, start, np.zeros(size), rng.normal(0, 0.05, (size, rank)))
    seen_l, seen_f, seen_b = np.full(size, 1e-3), np.full((size, rank), 1e-3), 1e-3
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) * 0.5 + 0.5
    for _ in range(epochs):
        order = rng.permutation(len(items))
        for i in range(0, len(order), 32):
            own = order[i:i + 32]
            ids, x, starts = m.rows([items[j] for j in own])
            raw, s = m.sums(ids, x, starts)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[own]) * weight[own] / len(own)
            row = np.repeat(np.arange(len(own)), np.diff([*starts, len(ids)]))
            part, inverse = np.unique(ids, return_inverse=True)
            gl = np.bincount(inverse, g[row] * x, len(part)) + l2 * m.linear[part]
            each = (g[row] * x)[:, None] * (s[row] - m.factors[ids] * x[:, None])
            gf = np.stack([np.bincount(inverse, each[:, f], len(part)) for f in range(rank)], 1) + l2 * m.factors[part]
            seen_l[part] += gl**2
            seen_f[part] += gf**2
            seen_b += g.sum() ** 2
            m.linear[part] -= rate * gl / np.sqrt(seen_l[part])
            m.factors[part] -= rate * gf / np.sqrt(seen_f[part])
            m.bias -= rate * g.sum() / np.sqrt(seen_b)
    return m


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        chars_col: str = "n_chars", max_rows: int = 4000, rank: int = 8, epochs: int = 6, rate: float = 0.1,
        l2: float = 1e-6, seed: int = 1) -> Machine:
    """Fit on at most ``max_rows`` labelled ids; features of their texts, not the texts, reach the driver."""
    sample = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .select(F.col(label_col).cast("int").alias("label"), F.col(id_col).alias("__id"))
              .orderBy(F.xxhash64("__id"), "__id", "label").limit(max_rows).dropDuplicates(["__id"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                at, value, dense = zip(*map(features, part.column(1).to_pylist(), part.column(2).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64())),
                     pa.array(dense, pa.list_(pa.float64())), part.column(3)], ["label", "at", "value", "dense", "id"])

    rows = docs.select(id_col, text_col, F.col(chars_col).cast("long").alias("__chars")).join(
        F.broadcast(sample), F.col(id_col) == F.col("__id"))
    got = rows.select("label", text_col, "__chars", "__id").dropDuplicates(["__id"]).mapInArrow(
        run, "label int, at array<int>, value array<double>, dense array<double>, id long").toArrow().sort_by("id")
    items = [tuple(c.values.to_numpy() for c in r) for r in zip(got["at"], got["value"], got["dense"], strict=True)]
    return _train(items, got["label"].to_numpy(), rank, epochs, rate, l2, seed)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
          threshold: float = 0.7) -> DataFrame:
    """(id, score, predicted) of every row."""
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                s = machine.scores(list(map(features, part.column(1).to_pylist(), part.column(2).to_pylist())))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 [id_col, "score", "predicted"])

    return docs.select(id_col, text_col, F.col(chars_col).cast("long")).mapInArrow(run, schema)
