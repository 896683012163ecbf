"""Repeated passages against a comparison of all windows."""
from collections import Counter

import numpy as np
import pytest

from sparkwright.llm.substring_dedup import anchors, remove_repeats


def brute(docs, window):
    words = [(t or "").encode().split() for t in docs]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {q for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for q in range(i, i + window)}
        out.append((len(w), len(gone), b" ".join(x for q, x in enumerate(w) if q not in gone).decode()))
    return out


def test_anchors():
    rng = np.random.default_rng(0)
    g = rng.integers(0, 9, 200).astype(np.uint64)
    for n in (1, 2, 3, 7, 24):
        assert anchors(g, n).tolist() == [i + int(np.argmin(g[i:i + n])) for i in range(len(g) - n + 1)]


@pytest.mark.parametrize("window,gram", [(35, 12), (6, 2), (5, 5)])
def test_all_windows(spark, window, gram):
    rng = np.random.default_rng(window)
    vocab = [f"w{i}" for i in range(400)] + ["É", "日本"]

    def text(n):
        return rng.choice(vocab, n).tolist()

    passages = [text(n) for n in (34, 35, 36, 60, 200, 12)]
    docs = []
    for i in range(120):
        parts = text(int(rng.integers(0, 90)))
        for _ in range(int(rng.integers(0, 3))):
            p = passages[int(rng.integers(0, len(passages)))]
            a = int(rng.integers(0, 3)) * len(p) // 6
            parts += p[a:len(p) - int(rng.integers(0, 2)) * 5] + text(int(rng.integers(0, 20)))
        docs.append("\n \t".join(parts) if i % 3 else " ".join(parts))
    docs += [None, "", " ", "one", docs[5], docs[5], "a b c " * 500, "z " * 100, " ".join(passages[4]), " ".join(passages[4] * 20)]
    df = spark.createDataFrame([(i if i % 11 else 0, t, i) for i, t in enumerate(docs)], "doc_id long, text string, row long")
    got = remove_repeats(df.repartition(4), window, gram).collect()
    want = [(i if i % 11 else 0, *r) for i, r in enumerate(brute(docs, window))]
    assert sorted(tuple(r)[:4] for r in got) == sorted(want)
    assert all(sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_removed for r in got)


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r)[:4] for r in remove_repeats(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()] == [(None, 0, 0, "")]
