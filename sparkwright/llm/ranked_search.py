"""Ranked lexical search by a dual-tree: the k best documents for each item, exactly.

Scores are BM25 in whole numbers.  A term weighs ``floor(1000 ln((2N+2)/(2df+1)))``;
its impact in a document is ``(10^9 tf) div (1000 tf + 20 m)`` with
``m = 50 + (50 n N) div L``; an item's score is the sum of weight times impact
over its distinct terms.

Two hierarchies meet.  Items are split by shared terms into leaves of at most 8
and groups of leaves; each node holds the largest weight of every term below it.
A task lays the documents it reads out in blocks, in the order of their main
term and length, under nodes of 16 and 128 documents that hold the largest
impact of every term.  The product of two nodes' maxima bounds the score of
every pair below them, so a pair of nodes goes at once when its bound is below
the weakest k-th score of its items.  The rest is opened level by level down to
pairs, which are scored in full.

The k-th scores start from a run over a sixteenth of the documents (each is the
k-th of fewer documents, so never too high) and rise within each task.  A task
hands on at most k documents an item, and a window ranks these.  Documents are
never shuffled.  The item side is broadcast; beyond ``max_bytes`` of item text it
is dealt into slices that run one after the other.

Null and empty texts have no terms and match nothing; N counts documents with a
term.  Each row of the items is an item of its own, with a null or a repeated id
too.  Equal scores rank by ascending ``doc_id``, null last, then by place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rows import numbered
from .textops import U64, Batch, chunks

LEAF, GROUP = 8, 32            # items of a leaf, of a group
SMALL, LARGE, BLOCK = 16, 128, 1024   # documents of a node of either level, and of a block
CELLS = 4 << 20                # cells of a block's dense matrix
SEED = 16                      # one document in so many gives the first k-th scores


class Items:
    """The items' distinct terms: hashes of the vocabulary, and each item's term numbers."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.rows = np.array([r for r, _ in rows], dtype=np.int64)
        batch = Batch([(t or "").encode("utf-8", "surrogatepass") for _, t in rows], "alnum", lower=True)
        self.vocabulary, numbers = np.unique(batch.hashes, return_inverse=True)
        self.terms = [np.unique(numbers[a:b]) for a, b in zip(batch.word_doc_starts[:-1], batch.word_doc_starts[1:])]
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.vocabulary & U64(0xFFFF)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.rows)

    def counts(self, batch: Batch, first: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document from ``first`` on, term, times) of the batch's documents first..stop."""
        a, b = batch.word_doc_starts[first], batch.word_doc_starts[stop]
        words, v = batch.hashes[a:b], max(1, len(self.vocabulary))
        doc = np.repeat(np.arange(stop - first), batch.n_words[first:stop])
        some = np.flatnonzero(self.maybe[(words & U64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, words[some])
        hit = at < len(self.vocabulary)
        hit[hit] = self.vocabulary[at[hit]] == words[some][hit]
        key = doc[some[hit]] * v + at[hit]
        if (stop - first) * v <= 8 * CELLS:
            times = np.bincount(key, minlength=1)
            key = np.flatnonzero(times)
            times = times[key]
        else:
            key, times = np.unique(key, return_counts=True)
        return key // v, key % v, times


def _leaves(items: list[int], terms: list[np.ndarray]) -> list[list[int]]:
    """Halve the items by the term that is nearest to half of them, down to leaves."""
    if len(items) <= LEAF:
        return [items]
    number, times = np.unique(np.concatenate([terms[i] for i in items]), return_counts=True)
    with_it, without = [], []
    if len(number):
        best = number[np.argmin(np.abs(2 * times - len(items)))]
        for i in items:
            at = np.searchsorted(terms[i], best)
            (with_it if at < len(terms[i]) and terms[i][at] == best else without).append(i)
    if not with_it or not without:
        with_it, without = items[:len(items) // 2], items[len(items) // 2:]
    return _leaves(with_it, terms) + _leaves(without, terms)


class Group:
    """A node of the item tree with its leaves: term weights and their maxima over columns of its own."""

    def __init__(self, leaves: list[list[int]], terms: list[np.ndarray], weight: np.ndarray):
        self.items = np.array([i for leaf in leaves for i in leaf], dtype=np.int64)
        self.columns = np.unique(np.concatenate([terms[i] for i in self.items]))
        self.weights = np.zeros((len(self.items), len(self.columns)))
        for k, i in enumerate(self.items):
            self.weights[k, np.searchsorted(self.columns, terms[i])] = weight[terms[i]]
        self.starts = np.cumsum([0, *(len(leaf) for leaf in leaves)])
        self.leaf_columns = [np.flatnonzero(self.weights[a:b].any(axis=0)) for a, b in zip(self.starts[:-1], self.starts[1:])]
        self.leaf_maxima = np.maximum.reduceat(self.weights, self.starts[:-1], axis=0)
        self.maxima = self.leaf_maxima.max(axis=0, initial=0)


class Tree:
    """The item tree under the corpus statistics: documents with a term, all terms, and the terms' document counts."""

    def __init__(self, items: Items, n_docs: int, n_terms: int, df: np.ndarray):
        self.items, self.n_docs, self.n_terms = items, n_docs, n_terms
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], dtype=np.float64)
        leaves = [leaf for leaf in _leaves([i for i in range(len(items)) if len(items.terms[i])], items.terms) if leaf]
        self.groups, part = [], []
        for leaf in leaves:
            if part and sum(map(len, part)) + len(leaf) > GROUP:
                self.groups.append(Group(part, items.terms, weight))
                part = []
            part.append(leaf)
        if part:
            self.groups.append(Group(part, items.terms, weight))


class Best:
    """The k best (score, doc_id, row) of each item so far, and the k-th score to reach."""

    def __init__(self, n_items: int, k: int, floor: np.ndarray):
        self.k, self.kth = k, floor.astype(np.int64)
        self.lists = [np.empty((0, 4), dtype=np.int64) for _ in range(n_items)]

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray, rows: np.ndarray) -> None:
        own = np.concatenate([self.lists[item], np.stack([score, no_id, ids, rows], axis=1)])
        if len(own) > self.k:
            own = own[np.lexsort((own[:, 3], own[:, 2], own[:, 1], -own[:, 0]))[:self.k]]
            self.kth[item] = max(self.kth[item], own[-1, 0])
        elif len(own) == self.k:
            self.kth[item] = max(self.kth[item], own[:, 0].min())
        self.lists[item] = own


def _maxima(matrix: np.ndarray, size: int) -> np.ndarray:
    return np.maximum.reduceat(matrix, np.arange(0, len(matrix), size), axis=0)


def _reaches(bound: np.ndarray, kth: np.ndarray) -> np.ndarray:
    """Whether a bound may reach the k-th score; sums over 2^53 are rounded, hence the margin."""
    return (bound * (1 + 1e-9) >= kth) & (bound > 0)


def _search_run(group: Group, dense: np.ndarray, best: Best, ids, no_id, rows) -> None:
    """Open the node pairs of one group and one run of documents that may hold a better pair."""
    small = _maxima(dense, SMALL)
    large = _maxima(small, LARGE // SMALL)
    kth = best.kth[group.items]
    alive = np.flatnonzero(_reaches(large @ group.maxima, kth.min()))
    if not len(alive):
        return
    leaf_kth = np.minimum.reduceat(kth, group.starts[:-1])
    pairs = _reaches(large[alive] @ group.leaf_maxima.T, leaf_kth)
    for leaf in np.flatnonzero(pairs.any(axis=0)):
        a, b = group.starts[leaf], group.starts[leaf + 1]
        columns = group.leaf_columns[leaf]
        weights = group.weights[a:b][:, columns]
        nodes = (alive[pairs[:, leaf]][:, None] * (LARGE // SMALL) + np.arange(LARGE // SMALL)).ravel()
        nodes = nodes[nodes < len(small)]
        near = small[np.ix_(nodes, columns)]
        nodes, near = (x[_reaches(near @ group.leaf_maxima[leaf, columns], leaf_kth[leaf])] for x in (nodes, near))
        if not len(nodes):
            continue
        wanted = _reaches(near @ weights.T, kth[a:b])
        for k in np.flatnonzero(wanted.any(axis=0)):
            docs = (nodes[wanted[:, k]][:, None] * SMALL + np.arange(SMALL)).ravel()
            docs = docs[docs < len(dense)]
            own = np.flatnonzero(weights[k])
            score = dense[np.ix_(docs, columns[own])].astype(np.int64) @ weights[k, own].astype(np.int64)
            item = group.items[a + k]
            keep = (score >= best.kth[item]) & (score > 0)
            if keep.any():
                docs = docs[keep]
                best.add(item, score[keep], ids[docs], no_id[docs], rows[docs])


def search_block(tree: Tree, batch: Batch, first: int, stop: int, best: Best, ids, no_id, rows) -> None:
    """Meet the item tree with the documents first..stop of a batch (their ids and rows are given from ``first`` on)."""
    doc, term, times = tree.items.counts(batch, first, stop)
    n = batch.n_words[first:stop].astype(np.int64)
    m = 50 + (50 * n * tree.n_docs) // max(1, tree.n_terms)
    impact = (1_000_000_000 * times) // (1000 * times + 20 * m[doc])
    # neighbours in the tree: documents with the same main term, by length
    main = np.zeros(stop - first, dtype=np.int64)
    order = np.argsort(times, kind="stable")
    main[doc[order]] = term[order]
    order = np.lexsort((n, main))
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    row = place[doc]
    ids, no_id, rows = ids[order], no_id[order], rows[order]
    for group in tree.groups:
        at = np.searchsorted(group.columns, term)
        at[at == len(group.columns)] = 0
        mine = np.flatnonzero(group.columns[at] == term)
        r, c, x = row[mine], at[mine], impact[mine]
        run = max(1, min(BLOCK, CELLS // len(group.columns)))
        for begin in range(0, stop - first, run):
            end = min(begin + run, stop - first)
            here = slice(None) if end - begin == stop - first else (r >= begin) & (r < end)
            dense = np.zeros((end - begin, len(group.columns)))
            dense[r[here] - begin, c[here]] = x[here]
            _search_run(group, dense, best, ids[begin:end], no_id[begin:end], rows[begin:end])


def _statistics(docs: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and for each term of the vocabulary the documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        total = np.zeros(len(items.vocabulary) + 2, dtype=np.int64)
        for b in batches:
            for _, texts in chunks(b):
                batch = Batch(texts, "alnum", lower=True)
                total[0] += np.count_nonzero(batch.n_words)
                total[1] += len(batch.starts)
                for first in range(0, len(texts), BLOCK):
                    term = items.counts(batch, first, min(first + BLOCK, len(texts)))[1]
                    total[2:] += np.bincount(term, minlength=len(items.vocabulary))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["what", "n"])

    out = np.zeros(len(shared.value.vocabulary) + 2, dtype=np.int64)
    for what, n in docs.select("text").mapInArrow(run, "what long, n long").groupBy("what").agg(F.sum("n")).collect():
        out[what] = n
    return int(out[0]), int(out[1]), out[2:]


def _best_of(docs: DataFrame, shared, k: int) -> DataFrame:
    """The k best of each item and task (item: its place in the slice)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, floor = shared.value
        best = Best(len(tree.items), k, floor)
        for b in batches:
            rows = b.column("row").to_numpy(zero_copy_only=False)
            no_id = b.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for at, texts in chunks(b):
                batch = Batch(texts, "alnum", lower=True)
                for first in range(0, len(texts), BLOCK):
                    stop = min(first + BLOCK, len(texts))
                    here = slice(at.start + first, at.start + stop)
                    search_block(tree, batch, first, stop, best, ids[here], no_id[here], rows[here])
        for item, found in enumerate(best.lists):
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), item), pa.int32()), pa.array(found[:, 0]),
                     pa.array(found[:, 2], mask=found[:, 1].astype(bool)), pa.array(found[:, 3])],
                    names=["item", "score", "doc_id", "row"])

    found = docs.mapInArrow(run, "item int, score long, doc_id long, row long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = 50, max_bytes: int = 4 << 20) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's k best documents with a score above 0."""
    spark = documents.sparkSession
    docs = numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = numbered(items, "item_id", "text")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices, out = max(1, -(-size // max_bytes)), None
    for s in range(n_slices):
        own = asked.where(F.pmod(F.xxhash64("row"), F.lit(n_slices)) == s) if n_slices > 1 else asked
        table = Items([(r.row, r.text) for r in own.select("row", "text").collect()])
        tree = Tree(table, *_statistics(docs, spark.sparkContext.broadcast(table)))
        floor = np.zeros(len(table), dtype=np.int64)
        seed = docs.where(F.pmod(F.xxhash64("row"), F.lit(SEED)) == 0)
        for r in _best_of(seed, spark.sparkContext.broadcast((tree, floor)), k).where(F.col("rank") == k).collect():
            floor[r.item] = r.score
        rows = spark.createDataFrame([(i, r) for i, r in enumerate(table.rows.tolist())], "item int, item_row long")
        part = _best_of(docs, spark.sparkContext.broadcast((tree, floor)), k).join(rows, "item")
        out = part if out is None else out.unionByName(part)
    return (out.join(asked.select(F.col("row").alias("item_row"), "item_id"), "item_row")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
