"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

A text is read word by word. Whenever a number of words divisible by ``BASE`` is complete, a
catcher is set up at its last word for the blocks of 8, 16, ... words that end there and that
are aligned to their own length. A catcher is asked only about words equal to its last one: at
distance d it compares its block of the size that belongs to d (8 for d < 16, else the power
of two with block <= d < 2 * block) with the suffix of the text. If they are equal, words have
begun to repeat at distance d: that stretch is followed word by word, as long as each new word
equals the one d before, and becomes a run when it ends with length >= max(24, 3 * d).

Every such run holds an aligned block of its size with a copy at distance d, so none is missed.
A distance is left out where a followed period divides it (the stretch is no new run). If the
suffix lies inside a run of a much shorter period, then equal blocks lie at many distances; of
them only those that bring the beginnings or the ends of both short runs together can grow, and
only they are followed. So a word meets at most two catchers of each size, and the work is
near n log n even for one word repeated for ever. A task holds the word numbers of one text.

Cases: null and empty texts have no words and no runs; repeated rows are treated each; ids are
not used; columns named like the result's are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from skyroute.llm.words import word_lists

BASE, LEAST, TIMES = 8, 24, 3
RUN = ("start", "length", "period")


class Stretch:
    """Words from ``start`` on that equal those a period before them, still growing."""

    __slots__ = ("start", "waiting")

    def __init__(self, start: int):
        self.start, self.waiting = start, None


def _block(distance: int) -> int:
    """The size of block that catches this distance."""
    return BASE if distance < 2 * BASE else 1 << distance.bit_length() - 1


class Catchers:
    """Runs of a text that is appended word by word (as numbers, equal for equal words)."""

    def __init__(self) -> None:
        self.words = array("i")
        self.followed: dict[int, Stretch] = {}
        self.ended: dict[int, tuple[list[int], list[int]]] = {}
        self.at_word: dict[int, list[int]] = {}
        self.runs: list[tuple[int, int, int]] = []

    def append_all(self, words) -> None:
        text, followed, at_word = self.words, self.followed, self.at_word
        for w in words:
            i = len(text)
            text.append(w)
            if followed:
                for q in [q for q in followed if text[i - q] != w]:
                    self._end(q, i)
            if (stations := at_word.get(w)) is not None:
                self._ask(stations, i)
            if not (i + 1) % BASE:
                at_word.setdefault(w, []).append(i)

    def close(self) -> list[tuple[int, int, int]]:
        """All runs as (start, length, period), by start and period."""
        while self.followed:
            self._end(next(iter(self.followed)), len(self.words))
        return sorted(self.runs, key=lambda r: (r[0], r[2]))

    def _ask(self, stations: list[int], i: int) -> None:
        """Compare the blocks of the catchers at ``stations`` with the suffix that ends at word i."""
        text, followed, expired = self.words, self.followed, 0
        for j in reversed(stations):
            q, most = i - j, (j + 1) & -(j + 1)
            if q >= 2 * most:
                expired += 1
            elif (m := _block(q)) <= most and q not in followed and text[j - m + 1] == text[i - m + 1] \
                    and not (followed and self._idle(j, q, m, i)) and text[j - m + 1:j + 1] == text[i - m + 1:i + 1]:
                self._follow(j - m + 1, q)
        if expired:
            stations[:] = [j for j in stations if i - j < 2 * ((j + 1) & -(j + 1))]

    def _idle(self, j: int, q: int, m: int, i: int) -> bool:
        """Whether nothing new can grow from the block of ``m`` words that ends at j and its copy that ends at i."""
        for p, run in self.followed.items():
            if not q % p and run.start <= j - m + 1:
                return True
        for p, run in self.followed.items():
            if 4 * p <= m and run.start <= i - m + 1 and (old := self._ended_at(p, j)) and old[0] <= j - m + 1 \
                    and i - run.start != j - old[0]:
                if run.waiting is None:
                    run.waiting = set()
                run.waiting.add(j)
                return True
        return False

    def _follow(self, start: int, q: int) -> None:
        text = self.words
        while start and text[start - 1] == text[start - 1 + q]:
            start -= 1
        self.followed[q] = Stretch(start)

    def _ended_at(self, p: int, j: int) -> tuple[int, int] | None:
        """The ended stretch of period p that word j is in."""
        starts, ends = self.ended.get(p, ((), ()))
        k = bisect_right(starts, j) - 1
        return (starts[k], ends[k]) if k >= 0 and j <= ends[k] else None

    def _end(self, q: int, i: int) -> None:
        """Word i (or the end of the text) is the first that breaks the stretch of period q."""
        run = self.followed.pop(q)
        length = i - run.start
        if length >= max(LEAST, TIMES * q):
            self.runs.append((run.start, length, q))
        if length >= 4 * q:
            starts, ends = self.ended.setdefault(q, ([], []))
            starts.append(run.start)
            ends.append(i - 1)
        if run.waiting and i < len(self.words):
            for j in run.waiting:
                self._meet_ends(q, j, i)

    def _meet_ends(self, p: int, j: int, i: int) -> None:
        """A stretch of period p ended before word i, as an earlier one did that the catcher at j lies in:
        follow their distance if the catcher's block and word i bear it out."""
        text, old = self.words, self._ended_at(p, j)
        q = i - 1 - old[1] if old else 0
        if q <= 0 or q in self.followed or text[i] != text[i - q]:
            return
        m = _block(q)
        if m <= (j + 1) & -(j + 1) and j + q < i and text[j - m + 1:j + 1] == text[j + q - m + 1:j + q + 1] \
                and text[j + 1:i - q] == text[j + q + 1:i] \
                and not any(not q % x and s.start <= j - m + 1 for x, s in self.followed.items()):
            self._follow(j - m + 1, q)


def runs_of(lists: Iterator[list[bytes]]) -> tuple[list[tuple[int, int, int]], list[list[bytes]]]:
    """(runs, word lists) of one text."""
    numbers: dict[bytes, int] = {}
    catchers, read = Catchers(), []
    for words in lists:
        catchers.append_all([numbers.setdefault(w, len(numbers)) for w in words])
        read.append(words)
    return catchers.close(), read


def collapsed(runs: list[tuple[int, int, int]], lists: list[list[bytes]]) -> bytes:
    """The words, joined by one space, without those that a run holds after its first period."""
    cuts: list[list[int]] = []
    for b, e in sorted((s + q, s + n) for s, n, q in runs):
        if cuts and b <= cuts[-1][1]:
            cuts[-1][1] = max(cuts[-1][1], e)
        else:
            cuts.append([b, e])
    out, first = [], 0
    for words in lists:
        at = 0
        for b, e in cuts:
            b, e = max(b - first, 0), min(e - first, len(words))
            if b < e:
                out += words[at:b]
                at = e
        out += words[at:]
        first += len(words)
    return b" ".join(out)


def with_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period) and ``collapsed_text``."""
    rest = [c for c in docs.columns if c not in ("runs", "collapsed_text")]
    run_type = StructType([StructField(c, LongType()) for c in RUN])
    schema = StructType([*[docs.schema[c] for c in rest], StructField("runs", ArrayType(run_type)),
                         StructField("collapsed_text", StringType())])
    arrow_type = pa.list_(pa.struct([(c, pa.int64()) for c in RUN]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, texts = [], []
            for text in b.column(b.num_columns - 1):
                runs, lists = runs_of(word_lists(text.as_py()))
                found.append([dict(zip(RUN, r, strict=True)) for r in runs])
                texts.append(collapsed(runs, lists).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, arrow_type), pa.array(texts, pa.string())],
                                             schema.names)

    return docs.select(*rest, F.col(text_col).cast("binary").alias("__text")).mapInArrow(run, schema)
