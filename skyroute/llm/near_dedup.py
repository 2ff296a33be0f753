"""MinHash near-duplicate groups with sequential Bayesian verification.

1. A pass over whole texts makes, per document, the set of hashed word shingles (64
   bits), a digest of that set, a MinHash signature and its band keys. It is written
   once to the shared folder.
2. Documents with equal sets form a class (its smallest id stands for it), so exact
   copies never meet in a band, however many there are.
3. In each band bucket every member is paired with the bucket's smallest id only. All
   pairs that share a bucket but are still in different components after that are
   compared block by block inside tasks (``across``), which emit the few that pass; so
   no link between different texts is lost and no group is expanded into all its pairs.
4. Pairs are checked signature batch by signature batch: a pair goes as soon as the
   posterior probability (uniform prior) of a similarity of ``threshold`` or more is
   below ``miss``. What survives is confirmed on the full shingle sets.
5. Components of the confirmed links by alternating large-star and small-star steps;
   each step is written to the shared folder.

With 50 bands of 5 rows a pair of similarity 0.8 shares no bucket with probability
2.4e-9; the Bayesian test adds about ``miss``.

Cases: null, empty and white-space texts have an empty set and are linked with nothing;
a text of fewer words than a shingle is one shingle; repeated rows are one document (an
id names one text); rows without an id are not linked (component null, kept); other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.llm.common import WordHashes, hinted, stored

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xC2B2AE3D27D4EB4F)


_hashes = WordHashes()


def _fold(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for w in columns:
        h = (h ^ w) * _ODD
        h = (h ^ (h >> np.uint64(29))) * _MUL
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - k + 1
    return np.unique(_fold([h[i:i + n] for i in range(k)] if n > 0 else [h[i:i + 1] for i in range(len(words))]))


class MinHash:
    """Signatures of ``bands * rows`` hash functions (multiply-add on 32 bits), and band keys."""

    def __init__(self, bands: int, rows: int, seed: int):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        self.mul = rng.integers(0, 2**32, bands * rows, np.uint64).astype(np.uint32) | np.uint32(1)
        self.add = rng.integers(0, 2**32, bands * rows, np.uint64).astype(np.uint32)
        self.buffer = np.empty((128, bands * rows), np.uint32)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self.mul), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), len(self.buffer)):
            part = x[i:i + len(self.buffer), None]
            v = self.buffer[:len(part)]
            np.multiply(part, self.mul, out=v)
            np.add(v, self.add, out=v)
            np.minimum(best, v.min(axis=0), out=best)
        return best

    def keys(self, signature: np.ndarray) -> np.ndarray:
        s = signature.astype(np.uint64).reshape(self.bands, self.rows)
        return _fold([np.arange(self.bands, dtype=np.uint64), *s.T]).view(np.int64)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, k: int, seed: int) -> DataFrame:
    """(id, n_shingles, digest, keys, signature); only the low 16 bits of each minimum are stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(bands, rows, seed)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part, out = b.slice(i, 512), []
                for t in _texts(part, 1):
                    s = shingle_set(t, k)
                    if len(s):
                        m = hasher.signature(s)
                        out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), hasher.keys(m),
                                    (m & np.uint32(0xFFFF)).astype(np.uint16).tobytes()))
                    else:
                        out.append((0, None, None, None))
                n, digest, keys, sig = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    ["id", "n_shingles", "digest", "keys", "signature"])
        _hashes.clear()  # idle workers hold no words

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(
        run, "id long, n_shingles long, digest binary, keys array<long>, signature binary")


def least_matches(sizes: list[int], threshold: float, miss: float) -> list[int]:
    """For n compared hashes, the least matches m with P(similarity >= threshold | m of n) >= miss."""
    s = (np.arange(200_000) + 0.5) / 200_000
    out = []
    for n in sizes:
        low, high = 0, n
        while low < high:
            m = (low + high) // 2
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            p = np.exp(log - log.max())
            low, high = (low, m) if p[s >= threshold].sum() >= miss * p.sum() else (m + 1, high)
        out.append(low)
    return out


def surviving(pairs: DataFrame, sigs: DataFrame, hashes: int, batch: int, threshold: float, miss: float) -> DataFrame:
    """The (a, b) that no signature batch rules out."""
    steps = [*range(batch, hashes, batch), hashes]
    least = least_matches(steps, threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, hashes) for c in (2, 3))
                alive = np.arange(part.num_rows)
                same = np.zeros(part.num_rows, np.int64)
                begin = 0
                for end, need in zip(steps, least, strict=True):
                    same[alive] += (x[alive, begin:end] == y[alive, begin:end]).sum(axis=1)
                    alive, begin = alive[same[alive] >= need], end
                yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(alive)) for c in (0, 1)], ["a", "b"])

    side = lambda c: sigs.select(F.col("id").alias(c), F.col("signature").alias(f"signature_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "signature_a", "signature_b")
    return joined.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """The (a, b) with 100 * intersection >= percent * union of their full sets."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(
                    [shingle_set(t, k).tobytes() for t in _texts(part, 1)], pa.binary())], ["id", "shingles"])
        _hashes.clear()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(linked, pa.bool_())) for c in (0, 1)], ["a", "b"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_col)
    full = stored(texts.join(hinted(ids, ids.count(), 32), "id", "left_semi").mapInArrow(sets, "id long, shingles binary"),
                  "near-sets").dropDuplicates(["id"])
    side = lambda c: full.select(F.col("id").alias(c), F.col("shingles").alias(f"shingles_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "shingles_a", "shingles_b")
    return joined.mapInArrow(compare, "a long, b long")


#: Members of a bucket, and bytes of their profiles, that are compared with each other at once (twice as much
#: where two blocks meet).
BLOCK, BLOCK_BYTES = 4096, 32 << 20


def across(split: DataFrame, docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, batch: int, k: int,
           percent: int, miss: float, seed: int) -> DataFrame:
    """(a, b) of different components that share a bucket and seem as alike as asked for.

    ``split`` has (key, id, component, n, size) of the buckets with several components, n being
    the number of a bucket's members and size that of their shingles. The members come
    together in blocks of about ``BLOCK`` rows or ``BLOCK_BYTES`` bytes (a larger bucket as
    pairs of blocks, in several tasks) with a profile of their text, and only the pairs that
    pass are emitted: by size, by the signature batches and by the number of common shingles,
    which 32-bit hashes never count too low. A pair is compared in the first of its
    buckets only.
    """
    steps = [batch, 2 * batch]
    least = least_matches(steps, percent / 100, miss)
    ids = stored(split.select("id").distinct(), "near-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_col)

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(bands, rows, seed)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                sets = [shingle_set(t, k) for t in _texts(part, 1)]
                signed = [hasher.signature(x) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([hasher.keys(m).astype(np.uint32).tobytes() for m in signed], pa.binary()),
                     pa.array([m[:steps[-1]].astype(np.uint16).tobytes() for m in signed], pa.binary()),
                     pa.array([np.sort(x.astype(np.uint32)).tobytes() for x in sets], pa.binary())],
                    ["id", "bands", "signature", "shingles"])
        _hashes.clear()

    profile = stored(texts.join(hinted(ids, ids.count(), 32), "id", "left_semi").mapInArrow(
        profiles, "id long, bands binary, signature binary, shingles binary"), "near-profiles").dropDuplicates(["id"])
    # a shingle takes four bytes of a profile
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(4 * F.col("size") / BLOCK_BYTES)).cast("int")
    placed = (split.select("key", "id", "component", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
                           F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
              .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "id",
                      "component", "block"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for b in batches:
            found = []
            places = list(zip(*(b.column(c).to_pylist() for c in range(3)), strict=True))
            for i, place in enumerate(places):
                if place != group:
                    found += _block_pairs(group, held, steps, least, percent)
                    group, held = place, []
                held.append(tuple(b.column(c)[i] for c in range(3, 9)))
            yield _pairs(found)
        yield _pairs(_block_pairs(group, held, steps, least, percent))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["key", "low", "high"]
    return (placed.join(profile, "id").select(*place, "id", "component", "block", "bands", "signature", "shingles")
            .repartition(parts, *place).sortWithinPartitions(*place).mapInArrow(compare, "a long, b long").distinct())


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.int64()),
                                       pa.array([max(p) for p in found], pa.int64())], ["a", "b"])


def _block_pairs(place: tuple | None, held: list[tuple], steps: list[int], least: list[int],
                 percent: int) -> list[tuple[int, int]]:
    if place is None or len(held) < 2:
        return []
    ids, component, block = (np.array([h[c].as_py() for h in held], np.int64) for c in range(3))
    if (component == component[0]).all():
        return []
    bands, signature = (np.stack([np.frombuffer(h[c].as_buffer(), t) for h in held]) for c, t in
                        ((3, np.uint32), (4, np.uint16)))
    shingles = [np.frombuffer(h[5].as_buffer(), np.uint32) for h in held]
    size = np.array([len(x) for x in shingles])
    band = int(np.flatnonzero(bands[0] == np.array([place[0]]).astype(np.uint32)[0])[0])
    one_block, out = place[1] == place[2], []
    for i in range(len(held) - 1):
        j = np.arange(i + 1, len(held))
        alike = 100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i])
        j = j[alike & (component[j] != component[i]) & (one_block | (block[j] != block[i]))]
        if band and len(j):
            j = j[~(bands[j, :band] == bands[i, :band]).any(axis=1)]
        for end, need in zip(steps, least, strict=True):
            if len(j):
                j = j[(signature[j, :end] == signature[i, :end]).sum(axis=1) >= need]
        if not len(j):
            continue
        own = shingles[i]
        others = np.concatenate([shingles[x] for x in j])
        at = np.searchsorted(own, others)
        at[at == len(own)] = 0
        both = np.add.reduceat((own[at] == others).astype(np.int64), np.r_[0, np.cumsum(size[j])[:-1]])
        for x in j[100 * both >= percent * (size[i] + size[j] - both)]:
            out.append((int(ids[i]), int(ids[x])))
    return out


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is its smallest id."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = stored(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots).distinct()
        state = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bands: int = 50, rows: int = 5, batch: int = 50, miss: float = 1e-6, seed: int = 1) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``."""
    sigs = stored(signatures(docs, id_col, text_col, bands, rows, k, seed), "minhash")
    known = sigs.where("id is not null and digest is not null")
    classes = known.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    copies = known.join(classes.where("n > 1"), "digest").where("id <> rep").select("id", "digest")
    banded = known.select("id", "digest", "keys", "n_shingles").join(copies, ["id", "digest"], "left_anti").select(
        "id", "n_shingles", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
    members = stored(banded.join(buckets, "key").select("key", "id", "pivot", "n_shingles").distinct(), "near-buckets")

    near = stored(known.select("id", "signature").join(members.select("id").distinct(), "id", "left_semi"),
                  "near-signatures").dropDuplicates(["id"])

    def linked(pairs: DataFrame) -> DataFrame:
        alike = stored(surviving(pairs, near, bands * rows, batch, percent / 100, miss), "near-pairs")
        return stored(confirmed(alike, docs, id_col, text_col, k, percent), "near-links")

    stars = members.where("id > pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    first = linked(stars)

    label = components(first)
    held = members.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = (held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"),
                                     F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("key", "n", "size"))
    split = stored(held.join(mixed, "key").select("key", "id", "component", "n", "size"), "near-split")
    crossing = stored(across(split, docs, id_col, text_col, bands, rows, batch, k, percent, miss, seed), "near-crossing")
    links = first.unionByName(stored(confirmed(crossing, docs, id_col, text_col, k, percent), "near-links"))

    final = components(links).withColumnRenamed("id", "rep").withColumnRenamed("component", "found")
    groups = classes.where("n > 1").select("digest", "rep")
    rep = F.coalesce("rep", "id")
    return (sigs.select("id", "n_shingles", "digest").join(groups, "digest", "left")
            .select("id", "n_shingles", F.when(F.col("id").isNotNull(), rep).alias("rep")).join(final, "rep", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("found", "rep").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
