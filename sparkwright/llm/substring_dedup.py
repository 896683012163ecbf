"""Repeated passages over indexed reference blocks, in place of a relative Lempel-Ziv parse.

The dealt method parses each document greedily against every reference block.
Here an equality join of blocks stands for that parse: which factors a greedy
parse would take follows from which blocks and windows occur elsewhere, and these
are found by joining hashes.  No document is walked with factors extended one by
one; that would need the whole index beside each document.  The spans are those
of all windows that occur elsewhere, exactly.

Blocks.  A document is cut where its content says so: each window of ``window``
words belongs to the smallest hash among its grams of ``gram`` words (its
anchor), and neighbouring windows with the same anchor form a block.  Equal
windows have equal anchors, so a block can share a window only with blocks of
the same anchor, wherever they are.  Anchors that occur once are dropped; the
others index the reference blocks of the whole corpus.

Factors.  Neighbouring blocks that occur elsewhere as wholes make up a factor.
At the boundaries of factors blocks are cut differently from document to document (the neighbours differ);
there each window is looked up alone among the windows of all blocks with that
anchor.  Factors hold whole windows, so they have at least ``window`` words, and
their words are the duplicates.  The result equals that of comparing all
windows with each other.

Scale.  One row goes through the shuffle for a block (about ``window / 3``
words), counts are added up before they are shuffled, no group is gathered, and
no pair of documents is made: a passage in n documents makes n rows.  Blocks
and windows are compared by 128 bits.

Null and empty texts have no words; texts shorter than a window lose nothing.
Rows with equal or null ids are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import shared_dir

from .rows import numbered
from .textops import U64, Batch, chunks, doc_ids, gram_hashes, mix, span_hashes

BLOCKS = "anchor long, block long, row long, first int, n int"
WINDOWS = "anchor long, hash long, row long, first int"
OUT = ("doc_id long, n_words long, n_removed long, kept string, starts array<int>, ends array<int>")


def anchors(grams: np.ndarray, per_window: int) -> np.ndarray:
    """For each window (``per_window`` consecutive grams) the leftmost gram with the smallest hash."""
    val, at, size = grams, np.arange(len(grams)), 1
    parts = {1: (val, at)}
    while size * 2 <= per_window:
        val, at = _least(val[:-size], at[:-size], val[size:], at[size:])
        size *= 2
        parts[size] = (val, at)
    n = len(grams) - per_window + 1
    val, at = (x[:n] for x in parts[size])
    done, rest = size, per_window - size
    for s in sorted(parts, reverse=True):
        if s <= rest:
            v, a = parts[s]
            val, at = _least(val, at, v[done:done + n], a[done:done + n])
            done, rest = done + s, rest - s
    return at


def _least(v: np.ndarray, a: np.ndarray, w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = v <= w
    return np.where(left, v, w), np.where(left, a, b)


def blocks_of(batch: Batch, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, block hash, document, first window and number of windows of each block."""
    words = batch.hashes
    valid = batch.gram_valid(window)
    if not valid.any():
        return tuple(np.empty(0, t) for t in (U64, U64, np.int64, np.int64, np.int64))
    grams = gram_hashes(words, gram)
    start = np.flatnonzero(valid)
    at = anchors(grams, window - gram + 1)[start]
    # An anchor position is in one document, so a change of it also ends a document's last block.
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], len(at)) - 1
    begin, end = start[first], start[last] + window
    doc = batch.word_doc[begin]
    return mix(grams[at[first]]), span_hashes(words, begin, end), doc, begin - batch.word_doc_starts[doc], last - first + 1


def reference_blocks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Blocks of all documents whose anchor occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in chunks(b):
                anchor, block, doc, first, n = blocks_of(Batch(texts), window, gram)
                rows = doc_ids(b, at, "row").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64)), pa.array(rows[doc]),
                     pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["anchor", "block", "row", "first", "n"])

    blocks = docs.select("row", "text").mapInArrow(run, BLOCKS)
    often = (blocks.groupBy("anchor").agg(F.count("*").alias("times"), F.min("block").alias("lo"), F.max("block").alias("hi"))
             .where("times > 1").select("anchor", (F.col("lo") == F.col("hi")).alias("whole")))
    # Read back from the checkpoint, the join has a plain shuffle on both sides, whose hot partitions Spark can split.
    return blocks.join(often.checkpoint(), "anchor")


def _windows(window: int):
    """Hash of each window of the listed blocks of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in chunks(b):
                batch = Batch(texts)
                grams = gram_hashes(batch.hashes, window)
                rows = doc_ids(b, at, "row").to_numpy()
                asked = b.column("blocks").slice(at.start, at.stop - at.start)
                flat, sizes = asked.flatten(), np.diff(asked.offsets.to_numpy())
                doc = np.repeat(np.arange(len(texts)), sizes)
                n = flat.field("n").to_numpy()
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                first = np.repeat(flat.field("first").to_numpy(), n) + inner
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(flat.field("anchor").to_numpy(), n)),
                     pa.array(grams[np.repeat(batch.word_doc_starts[doc], n) + first].view(np.int64)),
                     pa.array(np.repeat(rows[doc], n)), pa.array(first.astype(np.int32))],
                    names=["anchor", "hash", "row", "first"])
    return run


def repeated_spans(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Starts and ends (in words, not united) of what each document shares: row, starts, ends."""
    found = reference_blocks(docs, window, gram).checkpoint()
    mixed = found.where("not whole")
    kinds = mixed.groupBy("anchor", "block").agg(
        F.count("*").alias("times"), F.min(F.struct("row", "first", "n")).alias("one"))
    # Blocks that occur as a whole elsewhere.
    whole = (found.where("whole").select("row", "first", "n")
             .unionByName(mixed.join(kinds.where("times > 1").select("anchor", "block"), ["anchor", "block"])
                          .select("row", "first", "n")))
    # At the boundaries: windows of one block of each kind, those of single blocks to be judged.
    asked = kinds.select("anchor", "one.row", "one.first", "one.n").groupBy("row").agg(
        F.collect_list(F.struct("anchor", "first", "n")).alias("blocks"))       # at most the document's blocks
    # With the same columns as in the last join, the documents are shuffled once for both.
    windows = docs.join(asked, "row").select("row", "doc_id", "text", "blocks").mapInArrow(_windows(window), WINDOWS)
    shared = windows.groupBy("anchor", "hash").agg(F.count("*").alias("times")).where("times > 1").select("anchor", "hash")
    edges = windows.join(shared, ["anchor", "hash"]).select("row", "first", F.lit(1).alias("n"))
    spans = whole.unionByName(edges).select("row", "first", (F.col("first") + F.col("n") - 1 + window).alias("end"))
    # At most the document's windows.
    return spans.groupBy("row").agg(F.collect_list("first").alias("starts"), F.collect_list("end").alias("ends"))


def factors(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as the parse's maximal factors."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(starts, ends)):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_words, removed, kept, starts, ends = ([] for _ in range(5))
        for text, s, e in zip(*(b.column(c).to_pylist() for c in ("text", "starts", "ends"))):
            words = (text or "").encode("utf-8", "surrogatepass").split()   # ASCII white space only
            n_words.append(len(words))
            own = factors(s, e) if s else []
            for x, y in reversed(own):
                del words[x:y]
            removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            starts.append([x for x, _ in own])
            ends.append([y for _, y in own])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
             pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
            names=["doc_id", "n_words", "n_removed", "kept", "starts", "ends"])


def remove_repeats(documents: DataFrame, window: int = 35, gram: int = 12) -> DataFrame:
    """One row for each document: counts, the kept words joined by spaces, and the factors removed."""
    shared_dir(documents.sparkSession)
    docs = numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(docs, window, min(gram, window))
    return (docs.join(spans, "row", "left").select("doc_id", "text", "starts", "ends").mapInArrow(_cut, OUT))
