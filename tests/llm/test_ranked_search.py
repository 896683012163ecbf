"""Dual-tree search against scores of all pairs in plain loops."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkwright.llm import ranked_search as R
from sparkwright.llm.textops import Batch

DOCS, ITEMS = "doc_id long, text string", "item_id string, text string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=50):
    """Rows (item_id, rank, doc_id, score) by scoring every pair."""
    tf = [Counter(terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    N, L = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    out = []
    for item_id, text in items:
        own = []
        for (doc_id, _), c, size in zip(docs, tf, n):
            m = 50 + (50 * size * N) // L if L else 0
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                own.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(own)[:k], 1)]
    return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def run(spark, docs, items, parts=3, **options):
    return ordered(R.search(spark.createDataFrame(docs, DOCS).repartition(parts), spark.createDataFrame(items, ITEMS), **options).collect())


def made(seed, n=400):
    """Documents of two languages with copies, one term in a third of the rows, and texts of very different lengths."""
    rng = random.Random(seed)
    vocabularies = [[f"a{i}" for i in range(60)], [f"Bé{i}" for i in range(60)]]
    docs = [(i, " ".join(rng.choices(v := rng.choice(vocabularies), k=rng.choice([0, 1, 5, 40, 300]))
             + ["common"] * (i % 3 == 0))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(80)]
    items = [(f"q{i}", " ".join(rng.choices(rng.choice(vocabularies), k=rng.randint(1, 20)))) for i in range(70)]
    return docs, items + [("c", "common"), ("none", "nowhere"), ("d", docs[7][1])]


@pytest.mark.parametrize("seed, k", [(1, 50), (2, 3), (3, 1000)])
def test_all_pairs(spark, seed, k, monkeypatch):
    docs, items = made(seed)
    assert run(spark, docs, items, k=k) == brute(docs, items, k)


def test_odd_rows(spark):
    docs, items = made(4, 60)
    docs += [(None, docs[9][1]), (None, "common common"), (5, None), (6, ""), (6, "?!"), (7, docs[7][1]), (7, docs[7][1]),
             (8, "common " * 200_000), (9, "x" * 300_000 + " common")]
    items += [(None, "common"), ("c", "common"), ("n", None), ("e", ""), ("l", " ".join(f"t{i}" for i in range(30_000)) + " common")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, max_bytes=60_000) == brute(docs, items)      # four slices


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], [("q", "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [("q", None)]) == []
    docs, items = made(5, 30)
    d = spark.createDataFrame([(*x, 1, "s", 2, "i") for x in docs], DOCS + ", row int, score string, rank int, item_id string")
    q = spark.createDataFrame([(*x, 1, 2, 3) for x in items], ITEMS + ", row int, item int, doc_id int")
    assert ordered(R.search(d, q).collect()) == brute(docs, items)


def test_bounds_prune_and_lose_nothing():
    """One block: whole nodes go, and what is left holds the best documents of every item."""
    docs, items = made(6, 900)
    table = R.Items(list(enumerate(t for _, t in items)))
    batch = Batch([t.encode() for _, t in docs], "alnum", lower=True)
    df = np.zeros(len(table.vocabulary), dtype=np.int64)
    np.add.at(df, table.counts(batch, 0, len(docs))[1], 1)
    tree = R.Tree(table, int(np.count_nonzero(batch.n_words)), len(batch.starts), df)
    best, scored = R.Best(len(items), 2, np.zeros(len(items))), []
    add, R.Best.add = R.Best.add, lambda self, item, score, *rest: (scored.append(len(score)), add(self, item, score, *rest))[1]
    try:
        ids = np.array([i for i, _ in docs])
        for _ in range(2):      # the second time the k-th scores are those of the whole table
            scored.clear()
            best.lists = [x[:0] for x in best.lists]
            R.search_block(tree, batch, 0, len(docs), best, ids, np.zeros(len(docs), dtype=np.int64), np.arange(len(docs)))
    finally:
        R.Best.add = add
    assert sum(scored) < 0.2 * len(docs) * len(items)
    got = ordered((items[i][0], rank, int(r[2]), int(r[0])) for i, own in enumerate(best.lists)
                  for rank, r in enumerate(own[np.lexsort((own[:, 2], -own[:, 0]))], 1))
    assert got == brute(docs, items, 2)
