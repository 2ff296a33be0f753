"""Substring dedup: Rabin-Karp hashes of every window of ``size`` words, counted in Spark.

Words are hashed to 64 bits, windows by two polynomials of those hashes modulo 2**64 (from
prefix sums, so a window costs a few machine operations however long it is). Spark deals the
windows to buckets by hash, where equal ones are put in the order of (id, start): every window
but the first is a repeat. The repeats of a document merge into maximal intervals of words,
which are removed. Documents are joined with their few intervals, never with windows.

Each task first compares the windows of a block of about a million words: whatever repeats
inside the block leaves as ranges, so a passage that a third of all documents share sends one
window a block to its bucket. The other windows of a block go to each bucket as one packed
row: hashes, and starts and ids as small differences, about 12 bytes a window. The number of
buckets grows with the bytes of text, so that a bucket holds about a million windows and fits
in a task. Texts are split a megabyte at a time.

Cases: null and empty texts have no words, texts shorter than a window have no windows.
Ids are integers. Rows that share an id are one document in several forms: only a smaller id,
or an earlier start under the same id, makes a window a repeat, so equal rows get equal
results. A null id comes after all others. Columns named like the result's are replaced; an
empty table gives an empty result. Equal windows share 80 bits of hash and the bucket, 87 bits
at least and one more with each doubling of the text: less than one pair of different windows in
100 TB of text would be taken for equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegralType

from skyroute.llm.common import WordHashes, hinted, stored
from skyroute.llm.words import word_lists

#: Words of a block, inside which repeats are found before the shuffle.
BLOCK_WORDS = 1 << 20
#: Bytes of text a bucket, and the least number of buckets (a power of two).
BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 128
#: Odd multipliers of the two polynomials.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_TIE, _ID = "__tie", "__id"
_FOUND = f"{_ID} long, {_TIE} long, starts array<int>, counts array<int>"
#: What a packed row holds: of each document its null flag, id, tie and numbers of windows and ranges; of each
#: window two hashes and its start; of each range of repeats its start and number of windows.
_KINDS = (np.bool_, np.int64, np.int64, np.int32, np.int32, np.uint64, np.uint16, np.int64, np.int64, np.int32)
_DIFFERENCES = (1, 7, 8)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Windows:
    """Rabin-Karp hashes of all windows of ``size`` words."""

    def __init__(self, size: int):
        self.size, self.n = size, 0

    def hashes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the windows starting at each word but the last ``size - 1``."""
        if len(words) > self.n:
            self.n = len(words)
            self.powers = [(_powers(b, self.n), _powers(pow(b, -1, 1 << 64), self.n)) for b in _BASES]
        out = []
        for up, down in self.powers:
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * up[:len(words)], dtype=np.uint64, out=sums[1:])
            out.append((sums[self.size:] - sums[:-self.size]) * down[:len(words) - self.size + 1])
        return out[0], out[1]


def _segments(text: bytes | None, size: int, kept: WordHashes) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the first word, word hashes) of pieces of a text that overlap by ``size - 1`` words."""
    first, tail = 0, np.empty(0, np.uint64)
    for words in word_lists(text):
        new = np.fromiter(map(kept.__getitem__, words), np.uint64, len(words))
        part = np.concatenate([tail, new]) if len(tail) else new
        if len(part) >= size:
            yield first, part
        rest = min(len(part), size - 1)
        first, tail = first + len(part) - rest, part[len(part) - rest:]


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of ``_KINDS`` as bytes: their lengths and compressed lengths, then the compressed arrays."""
    raw = [np.diff(a, prepend=a.dtype.type(0)) if i in _DIFFERENCES else a for i, a in enumerate(arrays)]
    parts = [pa.compress(a.astype(k, copy=False).tobytes(), "zstd", asbytes=True)
             for a, k in zip(raw, _KINDS, strict=True)]
    sizes = [[len(a) for a in raw], [len(p) for p in parts]]
    return np.array(sizes, np.int64).tobytes() + b"".join(parts)


def _unpack(blob: bytes) -> list[np.ndarray]:
    n = len(_KINDS)
    sizes, at, out = np.frombuffer(blob, np.int64, 2 * n).reshape(2, n), 16 * n, []
    for i, kind in enumerate(_KINDS):
        raw = pa.decompress(blob[at:at + sizes[1][i]], int(sizes[0][i]) * np.dtype(kind).itemsize, "zstd", asbytes=True)
        at += sizes[1][i]
        a = np.frombuffer(raw, kind)
        out.append(np.cumsum(a, dtype=kind) if i in _DIFFERENCES else a)
    return out


def _repeated(one: np.ndarray, two: np.ndarray, null: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether an equal window comes before each window in the order of (id, start), null ids last."""
    order = np.argsort(one, kind="stable")
    equal = one[order[1:]] == one[order[:-1]]
    grouped = np.zeros(len(one), bool)
    grouped[order[1:][equal]] = True
    grouped[order[:-1][equal]] = True
    g = np.flatnonzero(grouped)
    g = g[np.lexsort((start[g], key[g], null[g], two[g], one[g]))]
    head = np.ones(len(g), bool)
    head[1:] = (one[g[1:]] != one[g[:-1]]) | (two[g[1:]] != two[g[:-1]])
    first = g[np.maximum.accumulate(np.where(head, np.arange(len(g)), 0))]
    out = np.zeros(len(one), bool)
    out[g] = (null[g] != null[first]) | (key[g] != key[first]) | (start[g] != start[first])
    return out


def _block(segments: list[tuple], windows: Windows, buckets: int) -> pa.RecordBatch:
    """A row for each bucket of a block of (null id?, id, tie, first word, word hashes): the windows that
    the bucket has, without those that repeat in the block, and the ranges of those of some documents."""
    size = windows.size
    lengths = np.array([len(s[4]) for s in segments])
    ends = np.cumsum(lengths)
    at = np.concatenate([np.arange(e - n, e - size + 1) for e, n in zip(ends, lengths, strict=True)])
    one, two = windows.hashes(np.concatenate([s[4] for s in segments]))
    one, two = one[at], two[at]
    bits = buckets.bit_length() - 1
    bucket = (two >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(at), np.int64)
    short = (two >> np.uint64(48 - bits)).astype(np.uint16)
    null, key, tie = (np.array([s[i] for s in segments]) for i in range(3))
    segment = np.repeat(np.arange(len(segments)), lengths - size + 1)
    start = at - (ends - lengths - np.array([s[3] for s in segments]))[segment]

    later = _repeated(one, short.astype(np.int64) << 32 | bucket, null[segment], key[segment], start)
    r = np.flatnonzero(later)
    opens = np.ones(len(r), bool)
    opens[1:] = at[r[1:]] != at[r[:-1]] + 1
    ranges = r[opens]
    counts = np.diff(np.append(np.flatnonzero(opens), len(r)))
    # the ranges of a document travel with one of its block's buckets, in turn
    w = np.flatnonzero(~later)
    w = w[np.argsort(bucket[w], kind="stable")]
    g = np.argsort(segment[ranges] % buckets, kind="stable")
    ranges, counts = ranges[g], counts[g]
    w_cut = np.searchsorted(bucket[w], np.arange(buckets + 1))
    g_cut = np.searchsorted(segment[ranges] % buckets, np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        x, y, n = w[w_cut[b]:w_cut[b + 1]], ranges[g_cut[b]:g_cut[b + 1]], counts[g_cut[b]:g_cut[b + 1]]
        if not len(x) + len(y):
            continue
        used = np.union1d(segment[x], segment[y])
        numbers = [np.diff(np.searchsorted(segment[z], np.append(used, len(segments)))) for z in (x, y)]
        rows.append((b, _pack([null[used], key[used], tie[used], *numbers, one[x], short[x], start[x], start[y], n])))
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()),
                                       pa.array([p for _, p in rows], pa.binary())], ["bucket", "windows"])


def _windows(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """(bucket, windows) of (id, tie, text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, windows, held, n = WordHashes(), Windows(size), [], 0
        for b in batches:
            for key, tie, text in zip(*(b.column(i) for i in range(3)), strict=True):
                id_ = key.as_py()
                for first, hashes in _segments(text.as_py(), size, kept):
                    held.append((id_ is None, id_ or 0, tie.as_py(), first, hashes))
                    n += len(hashes)
                    if n >= BLOCK_WORDS:
                        yield _block(held, windows, buckets)
                        held, n = [], 0
        if held:
            yield _block(held, windows, buckets)

    return docs.mapInArrow(run, "bucket int, windows binary")


def _bucket_repeats(table: pa.Table) -> pa.Table:
    """(id, tie, starts, counts) of the repeats in a bucket: one row per document."""
    packed = [_unpack(b.as_py()) for b in table.column("windows")]
    joined = [np.concatenate([p[i] for p in packed]) for i in range(len(_KINDS))]
    null, key, tie, n_windows, n_ranges, one, two, start, range_start, range_count = joined
    doc = np.repeat(np.arange(len(key)), n_windows)
    later = _repeated(one, two, null[doc], key[doc], start)
    doc = np.concatenate([doc[later], np.repeat(np.arange(len(key)), n_ranges)])
    start = np.concatenate([start[later], range_start])
    count = np.concatenate([np.ones(int(later.sum()), np.int32), range_count])
    order = np.lexsort((start, tie[doc], key[doc], null[doc]))
    doc, start, count = doc[order], start[order], count[order]
    opens = np.ones(len(doc), bool)
    opens[1:] = ((null[doc[1:]] != null[doc[:-1]]) | (key[doc[1:]] != key[doc[:-1]]) | (tie[doc[1:]] != tie[doc[:-1]]))
    heads = np.flatnonzero(opens)
    cuts = pa.array(np.append(heads, len(doc)), pa.int32())
    lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int32())) for x in (start, count)]
    first = doc[heads]
    return pa.table([pa.array(key[first], pa.int64(), mask=null[first]), pa.array(tie[first], pa.int64()), *lists],
                    names=[_ID, _TIE, "starts", "counts"])


def _intervals(starts: pd.Series, counts: pd.Series, size: int) -> pd.DataFrame:
    """Maximal intervals of the words in windows at ``starts`` (each the first of ``counts`` consecutive ones)."""
    begins, ends = [], []
    for s, n in zip(starts, counts, strict=True):
        order = np.argsort(s, kind="stable")
        s = s[order].astype(np.int64)
        e = np.maximum.accumulate(s + n[order] - 1 + size)
        opens = np.ones(len(s), bool)
        opens[1:] = s[1:] > e[:-1]
        begins.append(s[opens])
        ends.append(e[np.append(np.flatnonzero(opens)[1:] - 1, len(s) - 1)])
    return pd.DataFrame({"b": begins, "e": ends})


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``docs`` with a column that tells apart rows of one id (0 if no id repeats, else a hash of the text), and
    the number of buckets."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise ValueError(f"{id_col}: ids must be integers")
    most, total = (docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("b"))
                   .agg(F.max("n"), F.sum("b")).first())
    buckets = max(LEAST_BUCKETS, 1 << max((total or 0) // BUCKET_BYTES - 1, 0).bit_length())
    return docs.withColumn(_TIE, F.xxhash64(text_col) if (most or 0) > 1 else F.lit(0).cast("long")), buckets


def repeats(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """(__id, __tie, __begins, __ends): the maximal intervals of repeated words of each row that has any.

    ``docs`` has the columns __id, __tie and text (binary), in this order.
    """
    if size < 2:
        raise ValueError("a window takes two words at least")
    merged = pandas_udf(lambda s, n: _intervals(s, n, size), "b array<bigint>, e array<bigint>")
    found = _windows(docs, size, buckets).groupBy("bucket").applyInArrow(_bucket_repeats, _FOUND)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "counts")]
    return (found.groupBy(_ID, _TIE).agg(*lists).withColumn("spans", merged("starts", "counts"))
            .select(_ID, _TIE, F.col("spans.b").alias("__begins"), F.col("spans.e").alias("__ends")))


def _kept(text: bytes | None, begins, ends) -> tuple[int, int, list]:
    """(words, removed words, kept word lists joined by one space) of a text."""
    n = removed = 0
    out, cuts = [], list(zip(begins, ends, strict=True)) if begins is not None else []
    for words in word_lists(text):
        at, keep = 0, []
        for b, e in cuts:
            b, e = max(b - n, 0), min(e - n, len(words))
            if b < e:
                keep += words[at:b]
                removed += e - b
                at = e
        keep += words[at:]
        n += len(words)
        if keep:
            out.append(b" ".join(keep))
    return n, removed, out


def _cleaned(text: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
    rows = [_kept(t, b, e) for t, b, e in zip(text, begins, ends, strict=True)]
    return pd.DataFrame({"n_words": [r[0] for r in rows], "n_removed": [r[1] for r in rows],
                         "kept_text": [b" ".join(r[2]).decode("utf-8", "replace") for r in rows]})


def without_repeats(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``removed`` (intervals [begin, end) of words) and ``kept_text``."""
    rows, buckets = _prepared(docs, id_col, text_col)
    thin = rows.select(F.col(id_col).cast("long").alias(_ID), _TIE, F.col(text_col).cast("binary").alias("t"))
    spans = stored(repeats(thin, size, buckets), "repeats")
    size_of = spans.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("__begins")), F.lit(0))).first()
    spans = spans.withColumnsRenamed({_ID: "__span_id", _TIE: "__span_tie"})
    joined = rows.join(hinted(spans, 1, 64 * size_of[0] + 16 * size_of[1]),
                       F.col(id_col).eqNullSafe(F.col("__span_id")) & (F.col(_TIE) == F.col("__span_tie")), "left")
    cleaned = pandas_udf(_cleaned, "n_words long, n_removed long, kept_text string")
    new = ("n_words", "n_removed", "removed", "kept_text")
    spans_of = F.coalesce(F.arrays_zip(F.col("__begins").alias("begin"), F.col("__ends").alias("end")),
                          F.array().cast("array<struct<begin:bigint,end:bigint>>"))
    return (joined.withColumn("__clean", cleaned(F.col(text_col).cast("binary"), "__begins", "__ends"))
            .select(*[c for c in docs.columns if c not in new], F.col("__clean.n_words"), F.col("__clean.n_removed"),
                    spans_of.alias("removed"), F.col("__clean.kept_text")))
