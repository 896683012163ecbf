"""Quality rules on words, symbols, lines and repeated substrings.

The words of some documents form one sequence in which words of different
documents differ.  Prefix doubling gives each suffix its rank, level by level
(equal ranks at level j: equal first 2^j words); only suffixes that are not yet
alone are sorted again.  Suffixes in order of rank are the suffix array; the
levels, read from the top, give the longest common prefix of neighbours.  Of a
text of more than ``KEEP`` words only the last level is kept, and the common
prefixes are found along the text instead, each starting from its predecessor's
length less one; memory is then a few numbers a word, whatever repeats.  In
the LCP intervals that hold a suffix, the largest value is the longest prefix
that occurs elsewhere in its document, so the union of the spans of all
maximal repeats of at least ``min_repeat`` words is the union over suffixes of
that prefix.  The verdict limits the covered share of words and the longest
repeat.

Null and empty texts have no words (and fail the base rule).  A document is
handled whole, whatever its length; the scan is read once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textops import U64, Batch, byte_hashes, chunks, doc_ids, mix

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
           "n_repeat_words": pa.int64(), "n_covered": pa.int64(), "longest_repeat": pa.int64(),
           "base_failed": pa.bool_(), "kept": pa.bool_()}
SCHEMA = "doc_id long, " + ", ".join(f"{c} {'boolean' if t == pa.bool_() else 'long'}" for c, t in COLUMNS.items())


#: Words up to which all levels are kept.
KEEP = 1 << 20


def suffix_levels(symbols: np.ndarray, left: np.ndarray, keep: bool = True) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... symbols, until all differ; without ``keep`` the first and last.

    ``left``: symbols from each position to the end of its document.  Equal
    symbols must be of one document.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    first = np.ones(n, dtype=bool)
    first[1:] = symbols[order][1:] != symbols[order][:-1]
    starts = np.flatnonzero(first).astype(np.int32)
    sizes = np.diff(np.append(starts, np.int32(n)))
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.repeat(starts, sizes)
    levels, k = [rank], 1
    active = order[np.repeat(sizes, sizes) > 1]                       # whole groups, in order of rank
    del order, first
    while len(active):
        key = rank[active].astype(np.int64)
        key *= n + 1
        more = np.flatnonzero(left[active] > k)
        key[more] += rank[active[more] + k] + np.int64(1)
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        del by, more
        old = rank[active]
        group = np.flatnonzero(np.append(True, old[1:] != old[:-1])).astype(np.int32)
        part = np.flatnonzero(np.append(True, key[1:] != key[:-1])).astype(np.int32)
        del key
        # a part's rank: its group's, and its place in the group
        size = np.diff(np.append(part, np.int32(len(active))))
        old = old[part] + part - group[np.searchsorted(group, part, side="right") - 1]
        rank = rank.copy() if keep or len(levels) == 1 else rank
        rank[active] = np.repeat(old, size)
        if keep or len(levels) == 1:
            levels.append(rank)
        k *= 2
        active = active[np.repeat(size, size) > 1]
    return levels


def neighbour_prefixes(symbols: np.ndarray, left: np.ndarray, rank: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix in order with the one before it (the first: 0).

    Along the text a suffix shares at least one symbol less with its neighbour
    than the suffix before it did, so all comparisons together are linear.
    """
    out = np.zeros(len(symbols), dtype=np.int32)
    place, order, rest, to = memoryview(rank), memoryview(suffixes), memoryview(left), memoryview(out)
    text, h = memoryview(symbols), 0
    for i in range(len(symbols)):
        at = place[i]
        if at == 0:
            h = 0
            continue
        j = order[at - 1]
        most = min(rest[i], rest[j])
        while h < most and text[i + h] == text[j + h]:
            h += 1
        to[at] = h
        h -= h > 0
    return out


def longest_repeats(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each position the longest prefix of its suffix that starts elsewhere too."""
    n = len(symbols)
    if not n:
        return np.zeros(0, dtype=np.int64)
    levels = suffix_levels(symbols, left, keep=n <= KEEP)
    suffixes = np.empty(n, dtype=np.int32)
    suffixes[levels[-1]] = np.arange(n, dtype=np.int32)
    if n > KEEP:
        lcp = np.append(neighbour_prefixes(symbols, left, levels[-1], suffixes), np.int32(0))
        out = np.empty(n, dtype=np.int64)
        out[suffixes] = np.maximum(lcp[:-1], lcp[1:])
        return out
    a, b = suffixes[:-1], suffixes[1:]
    near = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[near], b[near]
    common = np.zeros(len(near), dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        ok = (common < left[a]) & (common < left[b])
        same = np.flatnonzero(ok)
        same = same[levels[j][x[same]] == levels[j][y[same]]]
        common[same] += 1 << j
    lcp = np.zeros(n + 1, dtype=np.int64)
    lcp[near + 1] = common
    out = np.empty(n, dtype=np.int64)
    out[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return out


def covered(lengths: np.ndarray) -> np.ndarray:
    """True for positions that lie in ``[i, i + lengths[i])`` for some i."""
    step = np.zeros(len(lengths) + 1, dtype=np.int64)
    at = np.flatnonzero(lengths)
    np.add.at(step, at, 1)
    np.add.at(step, at + lengths[at], -1)
    return np.cumsum(step[:-1]) > 0


def before(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place and before the end."""
    out = np.zeros(len(flags) + 1, dtype=np.int32)
    np.cumsum(flags, out=out[1:], dtype=np.int32)
    return out


def duplicate_lines(batch: Batch) -> np.ndarray:
    """Per document: lines with a word that equal an earlier line."""
    ends = np.flatnonzero(batch.buf == 10)
    starts = np.append(0, ends[:-1] + 1).astype(np.int64)
    worded = np.searchsorted(batch.starts, ends) > np.searchsorted(batch.starts, starts)
    starts, ends = starts[worded], ends[worded]
    doc = np.searchsorted(batch.doc_starts, starts, side="right") - 1
    key = mix(byte_hashes(batch.buf, starts, ends) + mix(doc.astype(U64) + U64(1)))
    _, at = np.unique(key, return_index=True)
    n = batch.n_docs
    return np.bincount(doc, minlength=n)[:n] - np.bincount(doc[at], minlength=n)[:n]


def measure(texts: list[bytes], min_repeat: int) -> dict[str, np.ndarray]:
    batch = Batch(texts)
    n_words, starts = batch.n_words, batch.word_doc_starts
    doc = batch.word_doc
    left = np.repeat(starts[1:], n_words) - np.arange(len(doc))
    repeat = longest_repeats(mix(batch.hashes + mix(doc.astype(U64) + U64(1))), left)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(flags))
        return total[starts[1:]] - total[starts[:-1]]

    head = before((batch.buf & 0xC0) != 0x80)          # code points before a byte
    word_chars = per_doc(head[batch.ends] - head[batch.starts])
    del head
    symbol = before(SYMBOLS[batch.buf])
    longest = np.zeros(batch.n_docs, dtype=np.int64)
    np.maximum.at(longest, doc, repeat)
    return {"n_words": n_words, "word_chars": word_chars,
            "n_symbols": (symbol[batch.doc_starts[1:]] - symbol[batch.doc_starts[:-1]]).astype(np.int64),
            "n_dup_lines": duplicate_lines(batch),
            "n_repeat_words": per_doc(covered(np.where(repeat >= 5, 5, 0))),
            "n_covered": per_doc(covered(np.where(repeat >= min_repeat, repeat, 0))),
            "longest_repeat": longest}


def verdict(m: dict[str, np.ndarray], max_covered: int = 20, max_longest: int = 200, min_words: int = 10,
            max_repeat_words: int = 20) -> dict[str, np.ndarray]:
    """The measures with ``base_failed`` and ``kept``."""
    n = m["n_words"]
    failed = (n < min_words) | (100 * m["n_repeat_words"] > max_repeat_words * n)
    return m | {"base_failed": failed, "kept": ~failed & (100 * m["n_covered"] <= max_covered * n) & (m["longest_repeat"] <= max_longest)}


def quality(documents: DataFrame, min_repeat: int = 8, max_covered: int = 20, max_longest: int = 200,
            min_words: int = 10, max_repeat_words: int = 20) -> DataFrame:
    """One row for each document: measures, ``base_failed`` and ``kept``.

    ``max_covered``, ``max_repeat_words``: percent of the words; ``max_longest``: words.
    """

    limits = {"max_covered": max_covered, "max_longest": max_longest, "min_words": min_words, "max_repeat_words": max_repeat_words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in chunks(b):
                m = verdict(measure(texts, min_repeat), **limits)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids(b, at), *(pa.array(m[c], t) for c, t in COLUMNS.items())], names=["doc_id", *COLUMNS])

    return documents.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def keep_good(documents: DataFrame, min_repeat: int = 8, **limits) -> DataFrame:
    """The rows of ``documents`` that pass (limits as in ``quality``), with all their columns, in one pass over the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for _, texts in chunks(b):
                keep.append(verdict(measure(texts, min_repeat), **limits)["kept"])
            if keep:
                yield b.filter(pa.array(np.concatenate(keep)))

    return documents.mapInArrow(run, documents.schema)
