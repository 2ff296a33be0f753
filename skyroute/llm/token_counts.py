"""Token counts of whole texts, as the tokenizer library gives them.

Arrow batches go to ``mapInArrow`` and only lengths come back. Texts are cut at safe
boundaries: a place before a space that a non-space character follows and, in parts of more than
``LONG_CHARS`` characters, between a letter and a punctuation mark. The byte-level pre-tokenizer
always starts a new piece there, so counts of the parts add up to the count of the
whole. Parts next to a special string are encoded together with it. Parts are taken in groups of
about ``batch_bytes`` bytes, across texts and inside them. Counts of short parts are kept in a
bounded table per Python worker, and only unseen parts are encoded. So memory is bounded by the
longest run without such a boundary, not by the length of a text.

Cases: null and empty texts have 0 tokens; repeated rows are counted each; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Entries of a worker's table of counted parts, and the longest part kept in it (characters).
KEPT_PARTS, KEPT_CHARS = 1_000_000, 48

#: Characters from which on a part is cut at punctuation too.
LONG_CHARS = 1 << 14

_before_space = re.compile(r"(?= \S)").split
# Latin, CJK, kana or hangul letter before ASCII or CJK punctuation: letters on one side, none on the other
_after_letter = re.compile("(?<=[A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3])"
                           "(?=[.,;:!?()\u3001\u3002\uff0c\uff01\uff1f\uff1b\uff1a\u300c\u300d])").split
_counters: dict[str, tuple] = {}


def _encoder(path: str) -> Callable[[list[str]], list[int]]:
    """texts -> token counts without added special tokens, by the file's library."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]


def marks(path: str) -> list[str] | None:
    """The added tokens' strings if texts may be cut, else None.

    Only byte-level pre-tokenizers with the standard pattern and no normalizer are cut.
    """
    if not path.endswith(".json"):
        return None
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    safe = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and not spec["model"].get("dropout"))
    return [t["content"] for t in spec.get("added_tokens", [])] if safe else None


def counter(path: str, limit: int = 1 << 20) -> Callable[[list[str]], list[int]]:
    """The worker's counting function for one tokenizer file; the tokenizer is loaded once."""
    if path not in _counters:
        encode, added = _encoder(path), marks(path)
        # texts that may not be cut are one part each
        whole = lambda texts: encode([t for t, in texts])
        _counters[path] = (whole if added is None else _cached(encode), added)
    count, added = _counters[path]
    return lambda texts: _counts(texts, added, count, limit)


def _cached(encode: Callable[[list[str]], list[int]]) -> Callable[[list[list[str]]], list[int]]:
    known: dict[str, int] = {}

    def count(texts: list[list[str]]) -> list[int]:
        if len(known) > KEPT_PARTS:
            known.clear()
        new = {p for parts in texts for p in parts}.difference(known)
        short = [p for p in new if len(p) <= KEPT_CHARS]
        known.update(zip(short, encode(short), strict=True))
        once = {p: encode([p])[0] for p in new if len(p) > KEPT_CHARS}
        get = (lambda p: once[p] if p in once else known[p]) if once else known.__getitem__
        return [sum(map(get, parts)) for parts in texts]

    return count


def parts_of(text: str, added: list[str] | None) -> list[str]:
    """A text cut at safe boundaries; ``added`` are the special strings, None if texts may not be cut."""
    if added is None:
        return [text]
    parts = _before_space(text)
    if any(a in text for a in added):
        if any(" " in a for a in added):
            return [text]
        # what stands beside a special string may belong to it: it stays with its neighbours
        special = {j for i, p in enumerate(parts) if any(a in p for a in added) for j in (i - 1, i, i + 1)}
        joined: list[str] = []
        for i, p in enumerate(parts):
            if i in special and i - 1 in special and joined:
                joined[-1] += p
            else:
                joined.append(p)
        return joined
    return [q for p in parts for q in (_after_letter(p) if len(p) > LONG_CHARS else (p,))]


def _pieces(text: str, added: list[str] | None, size: int, limit: int) -> Iterator[tuple[int, list[str]]]:
    """(bytes, parts) of a text of ``size`` bytes, in lists of about ``limit`` bytes."""
    parts = parts_of(text, added)
    if size <= limit:
        yield size, parts
        return
    held: list[str] = []
    n = 0
    for p in parts:
        held.append(p)
        n += len(p.encode())
        if n >= limit:
            yield n, held
            held, n = [], 0
    if held:
        yield n, held


def _counts(texts: list[str], added: list[str] | None, count: Callable[[list[list[str]]], list[int]],
            limit: int) -> list[int]:
    """Token counts of texts, their parts encoded in groups of about ``limit`` bytes."""
    totals = [0] * len(texts)
    held: list[list[str]] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        for i, n in zip(owners, count(held), strict=True):
            totals[i] += n
        held.clear()
        owners.clear()

    for i, t in enumerate(texts):
        for n, parts in _pieces(t, added, len(t) if t.isascii() else len(t.encode()), limit):
            held.append(parts)
            owners.append(i)
            size += n
            if size >= limit:
                flush()
                size = 0
    flush()
    return totals


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, batch_bytes: int = 1 << 20) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``tokenizer`` is a file's path."""
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer, batch_bytes)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            counts = count(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([c > limit for c in counts], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
