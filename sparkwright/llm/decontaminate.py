"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``window`` words (a shorter item is one window);
a window is the set of its shingles of three words, each with its place.  All
shingles of the benchmark are counted over all documents and ordered by rarity
(count, then hash).  Whole containment needs one prefix token, so a window is
found by its rarest shingle alone.  A document's shingles join these tokens;
the place of the token gives the window's only possible start (positional
bound), which must leave room for the window in the document (length bound).
What is left is verified word by word.

The index is broadcast.  Its size is checked: beyond ``max_bytes`` of benchmark
text the items are dealt into slices that are joined one after the other, and
each document's spans are united.  Documents are never shuffled with one slice.

Null and empty texts have no words; items without words or without an id are
not used; items that share an id count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import numbered
from .textops import Batch, chunks, doc_ids, gram_hashes

SHINGLE = 3
SPANS = "row long, doc_id long, n_words long, starts array<int>, ends array<int>, items array<string>"
DIGEST = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Windows:
    """The windows of some items: word hashes, items, and the shingles with their place."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        batch = Batch([t.encode("utf-8", "surrogatepass") for _, t in items], "alnum", lower=True)
        words, self.items = batch.hashes, [i for i, _ in items]
        found: dict[bytes, set[int]] = {}
        for d in range(batch.n_docs):
            w = words[batch.word_doc_starts[d]:batch.word_doc_starts[d + 1]]
            for at in range(max(0, len(w) - window) + 1 if len(w) else 0):
                found.setdefault(w[at:at + window].tobytes(), set()).add(d)
        self.words = [np.frombuffer(k, dtype=np.uint64) for k in found]
        self.of = [sorted(v) for v in found.values()]
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.shingles = [gram_hashes(w, min(SHINGLE, len(w))) for w in self.words]
        self.padded = np.zeros((len(self.words), window), dtype=np.uint64)
        for i, w in enumerate(self.words):
            self.padded[i, :len(w)] = w

    def tokens(self) -> dict[int, np.ndarray]:
        """Distinct shingles by their length in words."""
        return {n: np.unique(np.concatenate([s for s, k in zip(self.shingles, self.size) if min(SHINGLE, k) == n] or
                                            [np.empty(0, np.uint64)])) for n in range(1, SHINGLE + 1)}

    def index(self, counts: dict[tuple[int, int], int]) -> dict[int, tuple]:
        """By shingle length: sorted prefix tokens, where each one's entries begin, windows and places."""
        out = {}
        for n in range(1, SHINGLE + 1):
            rows = []
            for i, s in enumerate(self.shingles):
                if min(SHINGLE, self.size[i]) == n:
                    at = min(range(len(s)), key=lambda k: (counts.get((n, int(s[k])), 0), int(s[k])))
                    rows.append((int(s[at]), i, at))
            if rows:
                rows.sort()
                token, first = np.unique(np.array([r[0] for r in rows], dtype=np.uint64), return_index=True)
                out[n] = (token, np.append(first, len(rows)), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        return out


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key among the sorted ones, or -1."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _count(documents: DataFrame, tokens: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """How often the given shingles (at most the benchmark's) occur in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {n: np.zeros(len(t), dtype=np.int64) for n, t in tokens.items()}
        for b in batches:
            for _, texts in chunks(b):
                batch = Batch(texts, "alnum", lower=True)
                for n, t in tokens.items():
                    grams = gram_hashes(batch.hashes, n)[batch.gram_valid(n)] if len(t) else t
                    if len(grams):
                        at = _lookup(t, grams)
                        total[n] += np.bincount(at[at >= 0], minlength=len(t))
        for n, t in tokens.items():
            some = np.flatnonzero(total[n])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), n), pa.int32()), pa.array(t[some].view(np.int64)), pa.array(total[n][some])],
                names=["n", "token", "times"])

    got = (documents.select("text").mapInArrow(run, "n int, token long, times long")
           .groupBy("n", "token").agg(F.sum("times").alias("times")).collect())
    return {(r.n, r.token & (2**64 - 1)): r.times for r in got}


def _join(batch: Batch, win: Windows, index: dict[int, tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified (document, first word, window) of a batch."""
    words, found = batch.hashes, []
    doc_of, begin, end = batch.word_doc, batch.word_doc_starts[:-1], batch.word_doc_starts[1:]
    for n, (token, first, window, place) in index.items():
        valid = np.flatnonzero(batch.gram_valid(n))
        if not len(valid):
            continue
        at = _lookup(token, gram_hashes(words, n)[valid])
        pos, at = valid[at >= 0], at[at >= 0]
        times = first[at + 1] - first[at]
        pos = np.repeat(pos, times)
        entry = np.repeat(first[at] - np.append(0, np.cumsum(times)[:-1]) if len(times) else at, times) + np.arange(len(pos))
        w, start, doc = window[entry], pos - place[entry], doc_of[pos]
        fits = (start >= begin[doc]) & (start + win.size[w] <= end[doc])
        w, start, doc = w[fits], start[fits], doc[fits]
        same = np.ones(len(w), dtype=bool)
        for k in range(win.padded.shape[1]):
            inside = k < win.size[w]
            same &= ~inside | (words[np.minimum(start + k, len(words) - 1)] == win.padded[w, k])
        found.append(np.stack([doc[same], (start - begin[doc])[same], w[same]]))
    return tuple(np.concatenate(found, axis=1)) if found else (np.empty(0, np.int64),) * 3


def indexes(docs: DataFrame, benchmark: DataFrame, window: int, max_bytes: int) -> Iterator[Broadcast]:
    """A broadcast index for each slice of the items; a slice has about ``max_bytes`` of text."""
    items = benchmark.selectExpr("cast(item_id as string) item_id", "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices = max(1, -(-size // max_bytes))
    for s in range(n_slices):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n_slices)) == s) if n_slices > 1 else items
        win = Windows([(r.item_id, r.text) for r in own.collect()], window)
        yield docs.sparkSession.sparkContext.broadcast((win, win.index(_count(docs, win.tokens()))))


def contaminated_spans(documents: DataFrame, benchmark: DataFrame, window: int = 10,
                       max_bytes: int = 4 << 20) -> DataFrame:
    """Per document: words, first and end word of each occurrence, and the items that occur."""
    docs = numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = [docs.mapInArrow(_spans(shared), SPANS) for shared in indexes(docs, benchmark, window, max_bytes)]
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")))
    return out.drop("row")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10, max_bytes: int = 4 << 20) -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""

    def clean(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            win, index = shared.value
            for b in batches:
                keep = []
                for _, texts in chunks(b):
                    keep.append(np.ones(len(texts), dtype=bool))
                    keep[-1][_join(Batch(texts, "alnum", lower=True), win, index)[0]] = False
                if keep:
                    yield b.filter(pa.array(np.concatenate(keep)))
        return run

    out = documents
    for shared in indexes(documents, benchmark, window, max_bytes):
        out = out.mapInArrow(clean(shared), documents.schema)
    return out


def _spans(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win, index = shared.value
        for b in batches:
            for at, texts in chunks(b):
                batch = Batch(texts, "alnum", lower=True)
                starts, ends, items = ([[] for _ in texts] for _ in range(3))
                for d, s, w in zip(*map(np.ndarray.tolist, _join(batch, win, index))):
                    starts[d].append(s)
                    ends[d].append(s + int(win.size[w]))
                    items[d].extend(win.items[i] for i in win.of[w])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids(b, at, "row"), doc_ids(b, at), pa.array(batch.n_words, pa.int64()),
                     pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
                     pa.array([sorted(set(i)) for i in items], pa.list_(pa.string()))],
                    names=["row", "doc_id", "n_words", "starts", "ends", "items"])
    return run


def contamination(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document with the counts and a digest of the items found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_hit, n_items, digest = [], [], []
            for starts, ends, items in zip(*(b.column(c).to_pylist() for c in ("starts", "ends", "items"))):
                last = hit = 0
                for s, e in sorted(zip(starts, ends)):
                    hit += max(0, e - max(s, last))
                    last = max(last, e)
                items = sorted(set(items))
                n_hit.append(hit)
                n_items.append(len(items))
                digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
                 pa.array(digest, pa.string()), pa.array([h > 0 for h in n_hit], pa.bool_())],
                names=[c.split(" ")[0] for c in DIGEST.split(", ")])

    return contaminated_spans(documents, benchmark, **options).mapInArrow(run, DIGEST)
