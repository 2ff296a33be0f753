"""Language identification with error-correcting output codes.

Each language has a codeword of bits; each bit has a binary classifier (logistic
regression over hashed byte trigrams of the whole text). A text is decoded to the
language with the least loss-weighted distance: the logistic losses of the bits'
margins, weighted by how reliable each bit is for each language. The text is flagged
``ambiguous`` if the runner-up's loss is within ``margin`` of the best.

The model is fitted on a bounded sample: at most ``per_language`` documents of a
language and ``max_docs`` in all, those with the smallest hashes of their ids. Only text
and language of the given training rows are used.

Cases: a null text or one without a letter is ``und`` with score 0 and not ambiguous; so
is every text if there is nothing to learn from; with one learned language every text
with a letter is that one; training rows with null language or text are skipped;
repeated rows and extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skyroute.llm.common import hinted, stored

#: Buckets of hashed trigrams.
BUCKETS = 1 << 13
UNDETERMINED = "und"

_maybe_letters = re.compile(r"[^\W\d_]+").finditer
#: A-Z to lower case; other ASCII that is no letter to a space; the rest stays.
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numerals such as a half or a Roman twelve are none."""
    return any(any(map(str.isalpha, m.group())) for m in _maybe_letters(text))


def features(text: str, block: int = 1 << 20) -> np.ndarray:
    """Unit vector of square-rooted trigram counts; blocks overlap by two bytes, so nothing is left out."""
    raw = b" " + text.encode().translate(_FOLDED) + b" "
    counts = np.zeros(BUCKETS, np.int64)
    for i in range(0, len(raw) - 2, block):
        x = np.frombuffer(raw, np.uint8, min(block + 2, len(raw) - i), i).astype(np.uint32)
        h = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D))
        counts += np.bincount((h ^ (h >> np.uint32(15))) >> np.uint32(19) if BUCKETS == 1 << 13 else h % BUCKETS,
                              minlength=BUCKETS)
    v = np.sqrt(counts, dtype=np.float32)
    return v / max(1.0, float(np.sqrt(counts.sum())))


def codewords(k: int, seed: int) -> np.ndarray:
    """k rows of +-1; all splits of the languages if they are few, else the best of random codes."""
    if 2 ** (k - 1) - 1 <= 15:
        bits = [[1 if c == 0 or not b >> (c - 1) & 1 else -1 for c in range(k)] for b in range(1, 2 ** (k - 1))]
        return np.array(bits, np.int8).T.reshape(k, -1)
    n = 10 * (k - 1).bit_length()
    rng, best = np.random.default_rng(seed), (-1, None)
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, n))
        apart = ((n - code.astype(int) @ code.T) // 2 + n * np.eye(k, dtype=int)).min()
        if np.abs(code.sum(axis=0)).max() < k and apart > best[0]:
            best = (apart, code)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  #: languages x bits
    weights: np.ndarray  #: languages x bits, rows add up to 1
    coef: np.ndarray  #: buckets x bits
    bias: np.ndarray
    typical: float = 0.0  #: median over training texts of the mean absolute margin

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.coef + self.bias

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Rows of features to the weighted loss of each language."""
        return (np.logaddexp(0, -self.margins(x)[:, None, :] * self.code) * self.weights).sum(axis=2)


def _fit_bits(x: np.ndarray, targets: np.ndarray, steps: int, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of all bits at once with Adam; both values of a bit weigh the same."""
    share = (targets > 0).mean(axis=0)
    weight = np.where(targets > 0, 0.5 / np.maximum(share, 1e-9), 0.5 / np.maximum(1 - share, 1e-9)) / len(x)
    coef = np.zeros((x.shape[1] + 1, targets.shape[1]), np.float32)
    m, v = np.zeros_like(coef), np.zeros_like(coef)
    for t in range(1, steps + 1):
        margin = x @ coef[:-1] + coef[-1]
        g = -targets * weight / (1 + np.exp(np.clip(targets * margin, -30, 30)))
        grad = np.vstack([x.T @ g.astype(np.float32), g.sum(axis=0, keepdims=True)]) + l2 * coef
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        coef -= (0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return coef[:-1], coef[-1]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_language: int = 300, max_docs: int = 2000, steps: int = 80, l2: float = 1e-5, seed: int = 1) -> Model:
    """Fit on a bounded sample of ``docs`` (see above); its features, not its texts, reach the driver."""
    thin = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("__id"))
    order = F.xxhash64("__id")
    # about twice the rows that are asked for, so that few rows of a language meet in its ranking; one row a
    # language goes to the tasks, so that no language's rows are brought together before they are few
    counts = stored(thin.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    counts = hinted(counts, counts.count(), 64)
    few = F.pmod(order, F.lit(1 << 20)) * F.col("n") <= F.lit(2 * per_language) * (1 << 20)
    ranked = (thin.join(counts, "lang").where(few).select("lang", "__id").distinct().withColumn(
        "__rank", F.row_number().over(Window.partitionBy("lang").orderBy(order, "__id"))))
    sample = ranked.where(F.col("__rank") <= per_language).orderBy("__rank", order).limit(max_docs)
    rows = docs.select(id_col, text_col).join(F.broadcast(sample), F.col(id_col) == F.col("__id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                vectors = [features(t) for t in part.column(1).to_pylist()]
                at = [np.flatnonzero(v) for v in vectors]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())),
                     pa.array([v[a] for v, a in zip(vectors, at, strict=True)], pa.list_(pa.float32())),
                     part.column(2)], ["lang", "at", "value", "id"])

    rows = rows.where(F.col(text_col).isNotNull()).select("lang", text_col, "__id").dropDuplicates(["__id"]).mapInArrow(
        run, "lang string, at array<int>, value array<float>, id long").toArrow().sort_by("id")
    found = rows["lang"].to_pylist()
    languages = sorted(set(found))
    x = np.zeros((len(found), BUCKETS), np.float32)
    for i, (at, value) in enumerate(zip(rows["at"], rows["value"], strict=True)):
        x[i, at.values.to_numpy()] = value.values.to_numpy()
    if len(languages) < 2:
        none = np.zeros((len(languages), 0))
        return Model(languages, none, none, np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    y = np.searchsorted(languages, found)
    code = codewords(len(languages), seed)
    coef, bias = _fit_bits(x, code[y].astype(np.float32), steps, l2)
    margins = x @ coef + bias
    right = np.sign(margins) == code[y]
    weights = np.array([right[y == c].mean(axis=0) for c in range(len(languages))]) + 1e-3
    return Model(languages, code, weights / weights.sum(axis=1, keepdims=True), coef, bias,
                 float(np.median(np.abs(margins).mean(axis=1))))


def decode(model: Model, texts: list[str | None], margin: float) -> list[tuple[str, float, bool]]:
    """(language, score, ambiguous) of each text."""
    out: list[tuple[str, float, bool]] = [(UNDETERMINED, 0.0, False)] * len(texts)
    rows = [i for i, t in enumerate(texts) if t and has_letter(t)]
    if not model.languages or not rows:
        return out
    if len(model.languages) == 1:
        for i in rows:
            out[i] = (model.languages[0], 1.0, False)
        return out
    losses = model.losses(np.array([features(texts[i]) for i in rows]))
    best = losses.argmin(axis=1)
    ordered = np.sort(losses, axis=1)
    p = np.exp(-(losses - ordered[:, :1]) * 4)
    for i, b, s, o in zip(rows, best, 1 / p.sum(axis=1), ordered, strict=True):
        out[i] = (model.languages[b], float(s), bool(o[1] - o[0] < margin))
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            margin: float = 0.05) -> DataFrame:
    """(id, lang_pred, score, ambiguous) of every row."""
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                lang, score, unsure = zip(*decode(model, part.column(1).to_pylist(), margin), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(unsure, pa.bool_())], [id_col, "lang_pred", "score", "ambiguous"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


#: A text of at least ``JUDGED_BYTES`` bytes and ``JUDGED_TRIGRAMS`` effective trigrams is in no learned language
#: if the bits' margins are on average below this share of a training text's (its median). Of 256,410 documents
#: no such text has less than 0.2, and shorter ones (a license line, a password) no less than 0.18; Cyrillic,
#: Chinese, Hindi and base-64 texts have 0.09 to 0.17. Short texts, or one word repeated, are not judged.
EVIDENCE, JUDGED_BYTES, JUDGED_TRIGRAMS = 0.17, 200, 48


def identified(model: Model, texts: list[str | None], evidence: float = EVIDENCE) -> list[bool]:
    """Whether each text has a letter and, if it says enough to tell, gives the bits' classifiers evidence.

    The effective number of trigrams is the inverse of the sum of their squared shares. If no two languages were
    learned, nothing can be said against any text with a letter.
    """
    out = [bool(t) and has_letter(t) for t in texts]
    rows = [i for i, yes in enumerate(out) if yes and len(texts[i].encode()) >= JUDGED_BYTES]
    if rows and len(model.languages) > 1:
        x = np.array([features(texts[i]) for i in rows])
        mean = np.abs(model.margins(x)).mean(axis=1)
        for i, m, same in zip(rows, mean, (x ** 4).sum(axis=1), strict=True):
            out[i] = bool(m >= evidence * model.typical or same * JUDGED_TRIGRAMS > 1)
    return out


def languages_of(model: Model, texts: list[str | None], evidence: float = EVIDENCE) -> list[str | None]:
    """The language each text is decoded to; ``und`` if it is not ``identified``, None if no language was learned."""
    decoded = decode(model, texts, 0.0)
    return [(lang if model.languages else None) if yes else UNDETERMINED
            for (lang, _, _), yes in zip(decoded, identified(model, texts, evidence), strict=True)]


def identify(docs: DataFrame, model: Model, text_col: str = "text", evidence: float = EVIDENCE,
             out: str = "lang_pred") -> DataFrame:
    """``docs`` with the language of every row (``languages_of``) as a further column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                found = languages_of(model, part.column(at).to_pylist(), evidence)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names)

    at, names = docs.columns.index(text_col), [*docs.columns, out]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, StringType())]))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", evidence: float = EVIDENCE) -> DataFrame:
    """``docs`` without the rows whose language is ``und``; all columns stay."""
    found = identify(docs, model, text_col, evidence, out="__lang_pred")
    return found.where(F.coalesce(F.col("__lang_pred"), F.lit("")) != UNDETERMINED).drop("__lang_pred")
