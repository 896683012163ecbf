"""Vectorised text helpers that run inside Arrow-batch tasks.

Texts of a batch are laid end to end in one byte buffer, so that words, lines
and n-grams of many documents are found by a few numpy passes.  Hashes are
64-bit: two different words meet with a chance of about 1e-19 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
#: Bytes of text handled at once; one longer text is still handled whole.
CHUNK_BYTES = 4 << 20
#: Longer buffers are hashed in runs of about so many bytes.
RUN_BYTES = 8 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (splitmix finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_POWERS = {"n": -1}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse, kept between batches."""
    if _POWERS["n"] < n:
        up, down = (np.full(n + 1, m, dtype=U64) for m in (_MULT, _INV))
        up[0] = down[0] = 1
        _POWERS.update(n=n, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return _POWERS["up"], _POWERS["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``values[start:end]`` (or of ``table[values]``) for each pair, whatever the spans' lengths.

    Spans in ascending order of a long buffer are hashed in runs, and a long span
    in pieces, so that what is held beside the buffer is bounded by ``RUN_BYTES``.
    """
    if len(values) > RUN_BYTES and len(starts) and (np.diff(starts) >= 0).all() and (np.diff(ends) >= 0).all():
        out, at = np.empty(len(starts), dtype=U64), 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + RUN_BYTES, side="right")))
            first = starts[at]
            if ends[at] - first > RUN_BYTES:
                out[at] = _long_hash(values[first:ends[at]], table)
                at += 1
                continue
            out[at:stop] = span_hashes(values[first:ends[stop - 1]], starts[at:stop] - first, ends[at:stop] - first, table)
            at = stop
        return out
    values = values if table is None else table[values]
    up, down = _powers(len(values))
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


def _long_hash(values: np.ndarray, table: np.ndarray | None) -> np.uint64:
    """``span_hashes`` of the whole buffer as one span, piece by piece."""
    up, h = _powers(RUN_BYTES)[0], 0
    for at in range(0, len(values), RUN_BYTES):
        piece = values[at:at + RUN_BYTES]
        piece = piece if table is None else table[piece]
        h += int(np.sum(piece * up[:len(piece)], dtype=U64)) * pow(_MULT, at, 1 << 64)
    whole = np.array([h % (1 << 64)], dtype=U64)
    return mix(whole + np.array([len(values)], dtype=U64) * U64(0xA0761D6478BD642F))[0]


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values (document borders are not looked at)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, dtype=U64)
    out = hashes[:m].copy()
    for k in range(1, n):
        out *= U64(_MULT)
        out += hashes[k:k + m]
    return mix(out)


def _word_table(kind: str) -> np.ndarray:
    inside = np.ones(256, dtype=bool)
    if kind == "space":          # words are [^\x20\x09-\x0D]+
        inside[0x20] = False
        inside[0x09:0x0E] = False
    elif kind == "alnum":        # words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
        inside[:0x80] = False
        inside[0x30:0x3A] = True
        inside[0x61:0x7B] = True
    else:
        raise ValueError(kind)
    return inside


_INSIDE = {k: _word_table(k) for k in ("space", "alnum")}


class Batch:
    """Words of some documents: byte spans, hashes and where each document begins.

    ``word_doc_starts[d]:word_doc_starts[d + 1]`` are the words of document d.
    """

    def __init__(self, texts: list[bytes], kind: str = "space", lower: bool = False):
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.doc_starts = np.concatenate([[0], np.cumsum(lengths)])
        buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if not len(texts):
            buf = buf[:0]
        if lower:
            buf = buf + ((buf >= 65) & (buf <= 90)).astype(np.uint8) * np.uint8(32)
        self.buf = buf
        inside = _INSIDE[kind][buf]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(buf) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[0::2], edges[1::2]     # a text always ends in \n
        self.word_doc_starts = np.searchsorted(self.starts, self.doc_starts)
        self._hashes = None

    @property
    def n_docs(self) -> int:
        return len(self.doc_starts) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_doc_starts)

    @property
    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs, dtype=np.int64), self.n_words)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.buf, self.starts, self.ends, _BYTE)
        return self._hashes

    def gram_valid(self, n: int) -> np.ndarray:
        """True where ``n`` words from here on lie in one document."""
        m = max(0, len(self.starts) - n + 1)
        left = np.repeat(self.word_doc_starts[1:], self.n_words)[:m] - np.arange(m)
        return left >= n


def byte_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(buf, starts, ends, _BYTE)


def chunks(batch: pa.RecordBatch, column: str = "text",
           size: int = CHUNK_BYTES) -> Iterator[tuple[slice, list[bytes]]]:
    """Cut an Arrow batch into runs of rows with about ``size`` bytes of text (null: empty)."""
    texts = batch.column(column)
    texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield slice(at, stop), [t or b"" for t in texts.slice(at, stop - at).to_pylist()]
        at = stop


def doc_ids(batch: pa.RecordBatch, rows: slice, column: str = "doc_id") -> pa.Array:
    return batch.column(column).slice(rows.start, rows.stop - rows.start)
