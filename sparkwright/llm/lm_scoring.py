"""Language-model scores from a log-frequency Bloom filter.

Counting: each task hashes the tokens and adjacent pairs of the training
documents, adds up equal ones, and sends the sorted hashes with their counts to
buckets, one packed row for a bucket and flush.  A hot word is one entry of
each flush.  A bucket adds its parts up and builds its part of the filter.

Filter: a count c is stored as its level 1 + floor(log_b c); an n-gram enters
the filter once for each level up to its own.  Asking for level 1, 2, ... until
a probe fails gives the level back (never too low; too high with the filter's
error rate).  The filter is as large as the corpus has n-grams: nothing is
dropped or pruned.

Score: log10 P(w | v) = log10((c(vw) + K p(w)) / (c(v) + K)), p(w) = (c(w) + 1) /
(N + V + 1), with the counts c of the filter; the first token follows the end
token.  The sum splits into a part for w and a part for v, so filter and exact
word counts can be dealt by the word's hash into slices of at most
``max_bytes``; a slice is broadcast and all documents are scored against it, and
a document's parts are added.  So the broadcast has a bound whatever the size
of the corpus: a larger one takes more slices.

Null and empty texts consist of the end token.  A null doc_id is a training
document.  Equal words are found by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import shared_dir

from .rows import numbered
from .textops import U64, Batch, chunks, doc_ids, mix

END = U64(0x5851F42D4C957F2D)
HIGH = U64(0xFFFF) << U64(48)
BASE, HASHES, BITS = 1.5, 5, 8
FLUSH_TOKENS = 1_000_000
PARTS = "bucket int, kind int, keys binary, counts binary"
TABLE = "bucket int, words binary, counts binary, large binary, n_words long, n_tokens long, filter binary"
SCORES = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def tokens(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and ends, of the token before each, and the tokens of each document."""
    n = batch.n_words
    out = np.empty(len(batch.hashes) + batch.n_docs, dtype=U64)
    ends = batch.word_doc_starts[1:] + np.arange(batch.n_docs)
    inner = np.ones(len(out), dtype=bool)
    inner[ends] = False
    out[inner], out[ends] = batch.hashes, END
    before = np.append(END, out[:-1])          # what ends a document also opens the next one
    return out, before, n + 1


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of pairs that sort into the bucket of the second word."""
    return (word & HIGH) | (mix(before * U64(0xC2B2AE3D27D4EB4F) + word) >> U64(16))


def levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def level_values(n: int = 128) -> np.ndarray:
    """The mean count of each level; 0 for level 0."""
    low, high = np.ceil(BASE ** np.arange(n) - 1e-9), np.ceil(BASE ** np.arange(1, n + 1) - 1e-9) - 1
    return np.append(0.0, np.maximum(low, (low + high) / 2))


def _places(keys: np.ndarray, level: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    g = mix(keys + U64((level * 2 + salt) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    return g & U64(0xFFFFFFFF), (g >> U64(32)) | U64(1)


def build_filter(entries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Filter bytes of (keys, counts) by order; the order is the salt."""
    levels = [levels_of(c) if len(c) else np.empty(0, np.int64) for _, c in entries]
    size = U64(max(64, -(-sum(int(q.sum()) for q in levels) * BITS // 8) * 8))   # whole bytes
    bits = np.zeros(int(size), dtype=bool)
    for salt, ((keys, _), q) in enumerate(zip(entries, levels)):
        for level in range(1, int(q.max(initial=0)) + 1):
            a, b = _places(keys[q >= level], level, salt)
            for i in range(HASHES):
                bits[((a + U64(i) * b) & U64(0xFFFFFFFF)) * size >> U64(32)] = True
    return np.packbits(bits, bitorder="little")


class Slice:
    """Some buckets: exact word counts and their part of the filter."""

    def __init__(self, rows: list, shift: int, first: int, last: int):
        """Buckets ``first`` to ``last``; those without a row are empty."""
        self.shift, self.first, self.last = shift, first, last
        rows = sorted(rows, key=lambda r: r["bucket"])
        self.words = np.concatenate([np.empty(0, U64), *(np.frombuffer(r["words"], U64) for r in rows)])
        self.counts = np.concatenate([np.empty(0, np.uint8), *(np.frombuffer(r["counts"], np.uint8) for r in rows)])
        self.large = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(r["large"], np.int64) for r in rows)])
        self.large_at = np.flatnonzero(self.counts == 255)
        parts = [np.frombuffer(r["filter"], np.uint8) for r in rows]
        self.bits = np.concatenate([np.zeros(8, np.uint8), *parts])          # eight bytes for empty buckets
        self.offset, self.size = np.zeros(last - first + 1, U64), np.full(last - first + 1, 64, U64)
        at = 8
        for r, p in zip(rows, parts):
            self.offset[r["bucket"] - first] = at * 8
            self.size[r["bucket"] - first] = len(p) * 8
            at += len(p)

    def inside(self, hashes: np.ndarray) -> np.ndarray:
        b = hashes >> U64(self.shift)
        return (b >= U64(self.first)) & (b <= U64(self.last))

    def exact(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words))
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        out = self.counts[at].astype(np.float64)
        large = np.flatnonzero(out == 255)
        out[large] = self.large[np.searchsorted(self.large_at, at[large])]
        return np.where(self.words[at] == words, out, 0)

    def level(self, keys: np.ndarray, salt: int) -> np.ndarray:
        """Levels by repeated probes."""
        bucket = ((keys >> U64(self.shift)) - U64(self.first)).astype(np.int64)
        out = np.zeros(len(keys), dtype=np.int64)
        alive = np.arange(len(keys))
        level = 0
        while len(alive):
            level += 1
            a, b = _places(keys[alive], level, salt)
            start, size = self.offset[bucket[alive]], self.size[bucket[alive]]
            for i in range(HASHES):
                at = start + ((((a + U64(i) * b) & U64(0xFFFFFFFF)) * size) >> U64(32))
                hit = (self.bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1
                if not hit.all():
                    keep = np.flatnonzero(hit)
                    alive, a, b, start, size = alive[keep], a[keep], b[keep], start[keep], size[keep]
                if not len(alive):
                    break
            out[alive] = level
        return out


def _add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, U64), np.empty(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]) if len(k) else [])
    return k[first], np.add.reduceat(c, first) if len(k) else c


def count_parts(docs: DataFrame, shift: int) -> DataFrame:
    """Packed counts of words (kind 0) and pairs (kind 1) by bucket."""

    def flush(found: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for kind, parts in enumerate(found):
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            bucket = (keys >> U64(shift)).astype(np.int32)
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(first[1:], len(keys))
            counts = counts.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[first]), pa.array(np.full(len(first), kind, np.int32)),
                 pa.array([keys[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                 pa.array([counts[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())],
                names=["bucket", "kind", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = [[], []]
        n = 0
        for b in batches:
            for _, texts in chunks(b):
                word, before, _ = tokens(Batch(texts, lower=True))
                found[0].append(word)
                found[1].append(pair_keys(before, word))
                n += len(word)
                if n >= FLUSH_TOKENS:
                    yield from flush(found)
                    found, n = [[], []], 0
        if n:
            yield from flush(found)

    return docs.mapInArrow(run, PARTS)


def merge_bucket(t: pa.Table) -> pa.Table:
    """One bucket's words with counts and its part of the filter."""
    kinds = t.column("kind").to_pylist()
    keys = [np.frombuffer(k, U64) for k in t.column("keys").to_pylist()]
    counts = [np.frombuffer(c, np.uint32).astype(np.int64) for c in t.column("counts").to_pylist()]
    orders = [_add_up([k for k, n in zip(keys, kinds) if n == kind], [c for c, n in zip(counts, kinds) if n == kind])
              for kind in (0, 1)]
    words, times = orders[0]
    row = [t.column("bucket")[0].as_py(), words.tobytes(), *pack_counts(times), len(words), int(times.sum()),
           build_filter(orders).tobytes()]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array([v], ty) for v, ty in zip(row, types)],
                    names=["bucket", "words", "counts", "large", "n_words", "n_tokens", "filter"])


def pack_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    """A byte for each count; 255 stands for the next one of the large counts."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype(np.int64).tobytes()


def with_split(documents: DataFrame, fold: int, of: int) -> DataFrame:
    rest = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % of
    return numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text",
                    F.coalesce(rest == fold, F.lit(False)).alias("held_out"))


def score(documents: DataFrame, fold: int = 2, of: int = 7, strength: float = 300.0,
          max_bytes: int = 84 << 20) -> DataFrame:
    """One row for each document; ``strength`` is K, ``max_bytes`` bounds a broadcast slice."""
    spark = documents.sparkSession
    shared_dir(spark)
    docs = with_split(documents, fold, of)
    # Four buckets for each shuffle partition, so that one is a small part of a task's memory.
    bits = max(4, min(16, 2 + (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))
    shift = 64 - bits
    model = (count_parts(docs.where("not held_out").select("text"), shift).groupBy("bucket")
             .applyInArrow(merge_bucket, TABLE).checkpoint())
    sizes = model.selectExpr("bucket", "n_words", "n_tokens",
                             "octet_length(words) + octet_length(counts) + octet_length(large) + octet_length(filter) as bytes").collect()
    n, v = sum(r.n_tokens for r in sizes), sum(r.n_words for r in sizes)
    slices, room = [[0]], max_bytes          # bucket numbers at which slices begin
    for r in sorted(sizes):
        if r.bytes > room and room < max_bytes:
            slices.append([r.bucket])
            room = max_bytes
        room -= r.bytes
    starts = [s[0] for s in slices]
    out = None
    for a, b in zip(starts, [*starts[1:], 1 << bits]):
        rows = model.where((F.col("bucket") >= a) & (F.col("bucket") < b)).drop("n_words", "n_tokens").toArrow().to_pylist()
        part = Slice(rows, shift, a, b - 1)
        out = _union(out, docs.mapInArrow(_scores(spark.sparkContext.broadcast(part), n, v, strength), SCORES))
    if len(starts) > 1:
        out = out.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.first("n_tokens").alias("n_tokens"),
            *(F.sum(c).alias(c) for c in ("n_known", "base_score", "score")))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _union(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def _scores(shared, n: int, v: int, strength: float):
    values, total = level_values(), float(n + v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: Slice = shared.value
        for b in batches:
            for at, texts in chunks(b):
                word, before, sizes = tokens(Batch(texts, lower=True))
                doc = np.repeat(np.arange(len(texts)), sizes)
                inside = part.inside(word)
                if not inside.all():
                    w, before, d = word[inside], before[inside], doc[inside]
                else:
                    w, d = word, doc
                distinct, back = np.unique(w, return_inverse=True)
                c = part.exact(distinct)
                quantised = values[part.level(distinct, 0)]
                p = (quantised + 1) / total
                pairs = values[part.level(pair_keys(before, w), 1)]
                gain = np.log10(pairs + strength * p[back])
                # Each token but the end is the context of the next one; an end is that of its document's first.
                lost = np.log10(quantised + strength)[back]
                k = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids(b, at, "row"), doc_ids(b, at), doc_ids(b, at, "held_out"), pa.array(sizes, pa.int64()),
                     pa.array(np.bincount(d, (c > 0)[back], k).astype(np.int64)),
                     pa.array(np.bincount(d, np.log10((c + 1) / total)[back], k)),
                     pa.array(np.bincount(d, gain - lost, k))],
                    names=[x.split(" ")[0] for x in SCORES.split(", ")])
    return run
