"""Resampling towards a target text: hashed features, Gumbel scores, exact top share.

Every run of 1 to ``grams`` words is a feature and falls into one of ``buckets``
by the crc32 of its bytes.  Counts of the raw and of the target texts give each
bucket a gain (a smoothed log ratio in thousandths); a document's weight is the
floored mean of its features' gains, read from an array of all gains.  Its score
adds Gumbel noise seeded by the id, so the highest scores are a sample without
replacement in proportion to the importance weights.

The winners are found by weighted median-of-medians selection.  The scored
documents are written once.  In each round a task gives, for every block of at
most 2^20 keys still in question, the block's size and median; the median of
these, weighted by the sizes, is the pivot.  At least a quarter of the keys lie on
either side of it, so a round discards a guaranteed share.  The round that counts
the keys up to the pivot also gives the medians of both sides, so it is one pass.
When fewer than an eighth of the keys last written are left they are written
anew, so all rounds together read a small multiple of the keys.  The last
``FINISH`` keys at most are sorted by the driver, which gives the exact cutoff.
The winners alone are sorted, by range, and ranked by their place.

A key is (score, doc_id, row): higher scores first, then smaller ids, a null id
last, then the place in the table, so that repeated rows have an order too.  A
null text has no words.  With a null id the noise is that of the string ``seed:``.
A table without words anywhere gives all documents the weight 0.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import scratch_path

from .rows import numbered
from .textops import Batch, chunks

BLOCK, FINISH = 1 << 20, 4096
#: Words up to this many bytes are hashed by column, and moved by tables; longer ones one by one.
LONG = 64
_POLYNOMIAL = 0xEDB88320
KEYS = ("worse", "no_id", "id", "row")      # ascending: the best key is the least
KEY_TYPES = "worse long, no_id long, id long, row long"


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLYNOMIAL), t >> 1)
    return t


_BYTES = _byte_table()


def _move_tables() -> np.ndarray:
    """[n, k, byte]: what byte k of a checksum becomes behind n further zero bytes."""
    out = np.zeros((LONG + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        x = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(LONG + 1):
            out[n, k] = x
            x = _BYTES[x & 255] ^ (x >> np.uint32(8))
    return out


_MOVE = _move_tables()


def word_checksums(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of every span of the buffer."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    from_long = np.searchsorted(-size[order], -LONG, side="left")
    out = np.zeros(len(starts), dtype=np.uint32)
    short = order[from_long:]
    left, at = size[short], starts[short]
    crc = np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(int(left[0]) if len(left) else 0):
        n = np.searchsorted(-left, -k, side="left")     # spans longer than k come first
        crc[:n] = _BYTES[(crc[:n] ^ buf[at[:n] + k]) & 255] ^ (crc[:n] >> np.uint32(8))
    out[short] = ~crc
    for i in order[:from_long]:
        out[i] = zlib.crc32(buf[starts[i]:ends[i]])
    return out


class Features:
    """The buckets of a batch's features: ``bucket`` and the first feature of each document."""

    def __init__(self, batch: Batch, grams: int, buckets: int):
        size = batch.ends - batch.starts
        own = word_checksums(batch.buf, batch.starts, batch.ends)
        space = np.uint32(32)
        crc, parts, docs = own, [own % np.uint32(buckets)], [batch.word_doc]
        for n in range(2, grams + 1):
            if len(size) < n:
                break
            # behind the run so far: one space, then the next word
            crc = ~crc[:-1]
            crc = ~(_BYTES[(crc ^ space) & 255] ^ (crc >> np.uint32(8)))
            after, more = own[n - 1:], np.minimum(size[n - 1:], LONG)
            joined = after.copy()
            for k in range(4):
                joined ^= _MOVE[more, k, (crc >> np.uint32(8 * k)) & 255]
            for i in np.flatnonzero(size[n - 1:] > LONG):
                joined[i] = zlib.crc32(batch.buf[batch.starts[i + n - 1]:batch.ends[i + n - 1]], int(crc[i]))
            crc = joined
            inside = batch.gram_valid(n)
            parts.append(crc[inside] % np.uint32(buckets))
            docs.append(batch.word_doc[:len(inside)][inside])
        self.bucket, self.doc = np.concatenate(parts).astype(np.int64), np.concatenate(docs)


def feature_counts(texts: DataFrame, grams: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts; a task hands on its sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, some in chunks(b):
                total += np.bincount(Features(Batch(some, "alnum", lower=True), grams, buckets).bucket, minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[full])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the smoothed log ratio of target to raw, for each bucket."""
    s_all, t_all, n = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(s_all + n)) / (float(s + 1) * float(t_all + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def gumbel(seed: int, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(shared, grams: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            for at, texts in chunks(b):
                batch = Batch(texts, "alnum", lower=True)
                f = Features(batch, grams, len(gain))
                n = np.bincount(f.doc, minlength=len(texts))
                total = np.zeros(len(texts), dtype=np.int64)
                np.add.at(total, f.doc, gain[f.bucket])
                weight = np.floor_divide(total, np.maximum(n, 1))
                ids = b.column("doc_id").slice(at.start, len(texts))
                noise = np.array([gumbel(seed, i) for i in ids.to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(at.start, len(texts)), ids, pa.array(batch.n_words, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(weight), pa.array(weight + noise)],
                    names=["row", "doc_id", "n_words", "n_features", "weight", "score"])
    return run


def _nth(keys: np.ndarray, n: int) -> tuple[int, ...]:
    """The n-th key in order: by the first column, among its equals by the next, and so on."""
    out = []
    for c in range(keys.shape[1]):
        column = keys[:, c]
        value = int(np.partition(column, n)[n])
        out.append(value)
        n -= int(np.count_nonzero(column < value))
        keys = keys[column == value]
    return tuple(out)


def _below(keys: np.ndarray, pivot: tuple[int, ...]) -> np.ndarray:
    """True for the keys that come before the pivot or are it."""
    less, equal = np.zeros(len(keys), dtype=bool), np.ones(len(keys), dtype=bool)
    for c, value in enumerate(pivot):
        less |= equal & (keys[:, c] < value)
        equal &= keys[:, c] == value
    return less | equal


def _medians(keys: DataFrame, low: tuple | None, pivot: tuple | None, high: tuple | None) -> list:
    """(side, size, median) of each block's keys in (low, high]: side 0 up to the pivot, side 1 beyond."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])

        def out(side):
            block = np.concatenate(held[side])
            held[side].clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([side]), pa.array([len(block)]), *(pa.array([v]) for v in _nth(block, (len(block) - 1) // 2))],
                names=["side", "size", *KEYS])

        for b in batches:
            own = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in KEYS], axis=1)
            if low is not None:
                own = own[~_below(own, low)]
            if high is not None:
                own = own[_below(own, high)]
            first = _below(own, pivot) if pivot is not None else np.zeros(len(own), dtype=bool)
            for side, part in enumerate((own[first], own[~first])):
                if len(part):
                    held[side].append(part)
                    if sum(map(len, held[side])) >= BLOCK:
                        yield out(side)
        for side in (0, 1):
            if held[side]:
                yield out(side)

    return [(r.side, r.size_, tuple(r[2:])) for r in
            keys.mapInArrow(run, f"side long, size long, {KEY_TYPES}").withColumnRenamed("size", "size_").collect()]


def _between(keys: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    """Keys in (low, high]; the first column's range reaches the scan."""
    key = F.struct(*KEYS)

    def bound(k):
        return F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip(KEYS, k)))

    if low is not None:
        keys = keys.where((F.col("worse") >= low[0]) & (key > bound(low)))
    if high is not None:
        keys = keys.where((F.col("worse") <= high[0]) & (key <= bound(high)))
    return keys


def cutoff(keys: DataFrame, n: int, finish: int = FINISH) -> tuple[int, ...] | None:
    """The n-th least key of the frame (columns ``KEYS``, no two keys equal); None for n = 0 or too few keys."""
    spark, low, high = keys.sparkSession, None, None
    blocks = _medians(keys, low, None, high)
    left = written = sum(size for _, size, _ in blocks)
    if not 0 < n <= left:
        return None
    while left > finish:
        # the weighted median of the medians
        blocks.sort(key=lambda x: x[2])
        seen = 0
        for _, size, median in blocks:
            seen += size
            if 2 * seen >= left:
                pivot = median
                break
        sides = _medians(keys, low, pivot, high)
        first = sum(size for side, size, _ in sides if side == 0)
        if n <= first:
            high, left, kept = pivot, first, 0
        else:
            low, left, n, kept = pivot, left - first, n - first, 1
        blocks = [x for x in sides if x[0] == kept]
        if left > finish and 8 * left < written:
            path = scratch_path(spark, "keys")
            _between(keys, low, high).write.parquet(path)
            keys, written = spark.read.parquet(path), left
    rest = sorted(tuple(r) for r in _between(keys, low, high).select(*KEYS).collect())
    return rest[n - 1]


def resample(documents: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, grams: int = 2,
             buckets: int = 10_000, seed: int = 7, finish: int = FINISH) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; rank is null where it is not drawn.

    ``floor(percent * N / 100)`` of the N documents with at least ``min_words`` words are drawn.
    """
    spark = documents.sparkSession
    docs = numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(feature_counts(docs, grams, buckets), feature_counts(target, grams, buckets))
    path = scratch_path(spark, "scored")
    docs.mapInArrow(_scores(spark.sparkContext.broadcast(gain), grams, seed),
                    "row long, doc_id long, n_words long, n_features long, weight long, score long").write.parquet(path)
    scored = (spark.read.parquet(path).withColumn("worse", -F.col("score"))
              .withColumn("no_id", F.col("doc_id").isNull().cast("long")).withColumn("id", F.coalesce("doc_id", F.lit(0))))
    eligible = scored.where(F.col("n_words") >= min_words)
    n = percent * eligible.count() // 100
    last = cutoff(eligible.select(*KEYS), n, finish)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= min_words) & (F.struct(*KEYS) <= F.struct(
        *(F.lit(v).cast("long").alias(c) for c, v in zip(KEYS, last))))
    # the winners by range; the upper bits of the number are the range's
    path = scratch_path(spark, "winners")
    (scored.where(drawn).repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
     .select(*columns, F.monotonically_increasing_id().alias("place")).write.parquet(path))
    winners = spark.read.parquet(path).withColumn("range", F.shiftright("place", 33))
    before, seen = {}, 0
    for r in winners.groupBy("range").count().orderBy("range").collect():
        before[r["range"]], seen = seen, seen + r["count"]
    offsets = spark.createDataFrame(list(before.items()), "range long, seen long")
    ranked = winners.join(F.broadcast(offsets), "range").select(
        *columns, (F.col("seen") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("rank"))
    return scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")).unionByName(ranked)
