"""Toxicity scores from a bidirectional gated recurrent network in numpy.

Inputs.  A word is the embedding of its hashed form next to the mean embedding
of its hashed character trigrams (bytes, with word borders); both are learnt.
A text is cut into windows of ``window`` words, each ``stride`` words after the
last, so windows overlap and every phrase of ``window - stride`` words lies whole in one.  Two gated recurrent layers read a window forwards
and backwards, attention pools their states, and a linear unit gives the
window's logit.  All windows of all texts are scored; a document's score is
that of its worst window.

Training runs on the driver, on at most ``max_docs`` labelled documents (half
of them toxic, the ones with the smallest hashed ids) of at most ``max_bytes``
of text each, outside the held-out fold.  Only documents are labelled, so the
loss is on a soft maximum over a document's windows.  The weights, a few hundred
kB whatever the input, are broadcast.

Null and empty texts score 0.  Without labelled documents of both kinds all
scores are 0.  Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import U64, Batch, chunks, doc_ids, mix

WORDS, TRIGRAMS, DIM, HIDDEN = 1 << 12, 1 << 13, 8, 8
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
CHUNK = 1 << 20
RUN = 1 << 13          # windows of one matrix


@dataclass
class Features:
    """Distinct words of some texts, and windows that point to them (``len(word)``: padding)."""

    word: np.ndarray       # bucket of each distinct word
    trigram: np.ndarray    # buckets of all trigrams, word after word
    begin: np.ndarray      # where a word's trigrams begin
    index: np.ndarray      # (windows, words): distinct word
    doc: np.ndarray        # document of each window


def features(texts: list[bytes], window: int, stride: int) -> Features:
    b = Batch(texts, lower=True)
    hashes, first, back = np.unique(b.hashes, return_index=True, return_inverse=True)
    starts, sizes = b.starts[first], (b.ends - b.starts)[first]
    begin = np.append(0, np.cumsum(sizes))
    at = np.repeat(starts - begin[:-1], sizes) + np.arange(begin[-1])
    byte = np.where(np.isin(b.buf, np.frombuffer(b" \t\n\v\f\r", np.uint8)), 0, b.buf).astype(U64)
    code = (byte[at - 1] << U64(16)) | (byte[at] << U64(8)) | byte[at + 1]   # a text is followed by a border
    n = b.n_words
    n_windows = np.where(n > 0, 1 + np.maximum(0, -(-(n - window) // stride)), 0)
    doc = np.repeat(np.arange(b.n_docs), n_windows)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    place = (b.word_doc_starts[doc] + inner * stride)[:, None] + np.arange(window)
    inside = place < b.word_doc_starts[doc + 1][:, None]
    index = np.where(inside, np.append(back, 0)[np.minimum(place, len(back))], len(hashes))
    return Features((hashes >> U64(20)).astype(np.int64) % WORDS, (mix(code + U64(1)) >> U64(20)).astype(np.int64) % TRIGRAMS,
                    begin, index, doc)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def new_weights(seed: int = 0, dtype=np.float32) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape, scale=None):
        return rng.normal(0, scale or 1 / np.sqrt(shape[0]), shape).astype(dtype)

    w = {"word": normal(WORDS, DIM, scale=0.1), "trigram": normal(TRIGRAMS, DIM, scale=0.3)}
    for side in "fb":
        w |= {f"in_{side}": normal(2 * DIM, 3 * HIDDEN), f"bias_{side}": np.zeros(3 * HIDDEN, dtype),
              f"rec_{side}": normal(HIDDEN, 3 * HIDDEN)}
    return w | {"att": normal(2 * HIDDEN, HIDDEN), "att_bias": np.zeros(HIDDEN, dtype), "att_out": normal(HIDDEN),
                "out": normal(2 * HIDDEN), "out_bias": np.zeros(1, dtype)}


def inputs(w: dict, f: Features) -> np.ndarray:
    """A row for each distinct word: word embedding, mean trigram embedding."""
    size = np.maximum(1, np.diff(f.begin))
    if not len(f.word):
        return np.zeros((0, 2 * DIM), w["word"].dtype)
    chars = np.add.reduceat(w["trigram"][f.trigram], f.begin[:-1]) / size[:, None].astype(w["word"].dtype)
    return np.concatenate([w["word"][f.word], chars], axis=1)


def scan(p: np.ndarray, rec: np.ndarray, index: np.ndarray, mask: np.ndarray, back: bool, keep: list | None):
    """States of one direction, (windows, words, HIDDEN); ``keep`` gets what the gradient needs."""
    n, steps = index.shape
    states = np.empty((n, steps, HIDDEN), p.dtype)
    h = np.zeros((n, HIDDEN), p.dtype)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        x, u = p[index[:, t]], h @ rec
        gate = sigmoid(x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
        r, z = gate[:, :HIDDEN], gate[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        m = mask[:, t, None]
        if keep is not None:
            keep.append((t, h, r, z, c, u[:, 2 * HIDDEN:], m))
        h = h + m * (1 - z) * (c - h)
        states[:, t] = h
    return states


def logits(w: dict, f: Features, keep: dict | None = None, x: np.ndarray | None = None) -> np.ndarray:
    """Logit of each window; ``x``: the inputs, if they are known."""
    x = inputs(w, f) if x is None else x
    mask = (f.index < len(f.word)).astype(x.dtype)
    states = []
    for side in "fb":
        p = np.concatenate([x @ w[f"in_{side}"] + w[f"bias_{side}"], np.zeros((1, 3 * HIDDEN), x.dtype)])
        steps = None if keep is None else keep.setdefault(side, [])
        states.append(scan(p, w[f"rec_{side}"], f.index, mask, side == "b", steps))
    h = np.concatenate(states, axis=2)
    a = np.tanh(h @ w["att"] + w["att_bias"])
    e = np.where(mask > 0, a @ w["att_out"], -1e9)
    e = np.exp(e - e.max(axis=1, keepdims=True))
    share = (e / e.sum(axis=1, keepdims=True)).astype(x.dtype)
    pooled = np.einsum("nt,nth->nh", share, h)
    if keep is not None:
        keep.update(x=x, h=h, a=a, share=share, pooled=pooled)
    return pooled @ w["out"] + w["out_bias"][0]


def gradients(w: dict, f: Features, keep: dict, d_logit: np.ndarray) -> dict[str, np.ndarray]:
    """Back through pooling, both directions, and the embeddings."""
    g = {"out": keep["pooled"].T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    h, a, share, x = keep["h"], keep["a"], keep["share"], keep["x"]
    d_pooled = d_logit[:, None] * w["out"]
    d_h = share[:, :, None] * d_pooled[:, None, :]
    d_share = np.einsum("nth,nh->nt", h, d_pooled)
    d_e = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
    g["att_out"] = np.einsum("nt,nth->h", d_e, a)
    d_a = d_e[:, :, None] * w["att_out"] * (1 - a * a)
    g["att"] = h.reshape(-1, 2 * HIDDEN).T @ d_a.reshape(-1, HIDDEN)
    g["att_bias"] = d_a.sum(axis=(0, 1))
    d_h = d_h + d_a @ w["att"].T
    d_x = np.zeros_like(x)
    for i, side in enumerate("fb"):
        rec = w[f"rec_{side}"]
        d_rec, d_p = np.zeros_like(rec), np.zeros((len(x) + 1, 3 * HIDDEN), x.dtype)
        d = np.zeros((len(f.index), HIDDEN), x.dtype)
        for t, before, r, z, c, u, m in reversed(keep[side]):
            d = d + d_h[:, t, i * HIDDEN:(i + 1) * HIDDEN]
            move = m * d
            d_c = move * (1 - z) * (1 - c * c)
            d_z = -move * (c - before) * z * (1 - z)
            d_r = d_c * u * r * (1 - r)
            gates = np.concatenate([d_r, d_z, d_c], axis=1)
            inner = np.concatenate([d_r, d_z, d_c * r], axis=1)
            np.add.at(d_p, f.index[:, t], gates)
            d_rec += before.T @ inner
            d = d - move * (1 - z) + inner @ rec.T
        d_p = d_p[:-1]
        g[f"rec_{side}"], g[f"bias_{side}"], g[f"in_{side}"] = d_rec, d_p.sum(axis=0), x.T @ d_p
        d_x += d_p @ w[f"in_{side}"].T
    g["word"], g["trigram"] = np.zeros_like(w["word"]), np.zeros_like(w["trigram"])
    np.add.at(g["word"], f.word, d_x[:, :DIM])
    size = np.diff(f.begin)
    np.add.at(g["trigram"], f.trigram, np.repeat(d_x[:, DIM:] / np.maximum(1, size)[:, None].astype(x.dtype), size, axis=0))
    return g


def soft_max_by_doc(s: np.ndarray, doc: np.ndarray, n: int, sharp: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """log(sum(exp(sharp * s))) / sharp over each document's windows, and each window's weight in it."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, doc, s)
    e = np.exp(sharp * (s - top[doc]))
    total = np.bincount(doc, e, n)
    return top + np.log(total) / sharp, e / total[doc]


def train(texts: list[bytes], toxic: np.ndarray, window: int, stride: int, steps: int = 250, batch: int = 20,
          rate: float = 0.02, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights fitted by Adam on balanced batches; ``shift`` puts the best cut at a score of 0.5."""
    w, rng = new_weights(seed), np.random.default_rng(seed)
    kinds = [np.flatnonzero(toxic == k) for k in (0, 1)]
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        own = np.concatenate([rng.choice(k, min(len(k), batch // 2), replace=False) for k in kinds])
        f, keep, y = features([texts[i] for i in own], window, stride), {}, toxic[own]
        s, weight = soft_max_by_doc(logits(w, f, keep), f.doc, len(own))
        d_doc = (sigmoid(s) - y) / len(own)
        g = gradients(w, f, keep, (d_doc[f.doc] * weight).astype(np.float32))
        now = rate * min(1, 2 * (1 - step / (steps + 1)))
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        for k, v in g.items():
            v = v * min(1.0, 1.0 / max(norm, 1e-9))
            mean[k] += 0.1 * (v - mean[k])
            square[k] += 0.01 * (v * v - square[k])
            w[k] -= (now * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    top = np.concatenate([document_logits(w, texts[i:i + 64], window, stride) for i in range(0, len(texts), 64)])
    w["shift"] = np.array([best_cut(top, toxic)])
    return w


def best_cut(top: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap between neighbours that gives the best balanced accuracy."""
    order = np.argsort(top, kind="stable")
    y = toxic[order]
    right = np.append(0, np.cumsum(y == 0)) / max(1, (y == 0).sum()) + np.append(np.cumsum((y == 1)[::-1])[::-1], 0) / max(1, y.sum())
    best = np.flatnonzero(right == right.max())
    k = int(best[len(best) // 2])
    v = np.clip(top[order], -30, 30)
    return float((v[max(0, k - 1)] + v[min(k, len(v) - 1)]) / 2)


def document_logits(w: dict, texts: list[bytes], window: int, stride: int) -> np.ndarray:
    """Logit of each document's worst window; -inf without words.  ``RUN`` windows at a time are one matrix."""
    f = features(texts, window, stride)
    x = inputs(w, f)
    top = np.full(len(texts), -np.inf)
    for at in range(0, len(f.doc), RUN):
        own = slice(at, at + RUN)
        np.maximum.at(top, f.doc[own], logits(w, Features(f.word, f.trigram, f.begin, f.index[own], f.doc[own]), x=x))
    return top


def held_out(fold: int, of: int):
    rest = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % of
    return F.coalesce(rest == fold, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, fold: int, of: int, max_docs: int, max_bytes: int,
        window: int, stride: int) -> dict[str, np.ndarray] | None:
    """Weights from a bounded sample of the labelled documents outside the fold, or None."""
    seen = labels.select("doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").where(~held_out(fold, of))
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = [seen.where(F.col("toxic") == k).groupBy("doc_id", "toxic").count().orderBy(*by).limit(max_docs // 2) for k in (0, 1)]
    sample = ids[0].unionByName(ids[1]).select("doc_id", "toxic")
    rows = (documents.select("doc_id", "text").where(F.octet_length("text").between(1, max_bytes))
            .join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
            .orderBy("doc_id", "toxic").collect())                 # at most max_docs of max_bytes
    rows = [r for r in rows if r.text.strip(" \t\n\v\f\r")]
    toxic = np.array([r.toxic for r in rows], dtype=np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    return train([r.text.encode("utf-8", "surrogatepass") for r in rows], toxic, window, stride)


def score_toxicity(documents: DataFrame, labels: DataFrame, fold: int = 0, of: int = 5, max_docs: int = 3000,
                   max_bytes: int = 6000, window: int = 32, stride: int = 8) -> DataFrame:
    """One row for each document."""
    weights = fit(documents, labels, fold, of, max_docs, max_bytes, window, stride)
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            for at, texts in chunks(b, size=CHUNK):
                score = np.zeros(len(texts)) if w is None else sigmoid(document_logits(w, texts, window, stride) - w["shift"][0])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids(b, at), doc_ids(b, at, "held_out"), pa.array(score, pa.float64()),
                     pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(fold, of).alias("held_out"))
    return docs.mapInArrow(run, SCHEMA)
