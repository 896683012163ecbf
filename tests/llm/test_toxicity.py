"""The network's gradient by finite differences, windows, and held-out accuracy."""
import zlib

import numpy as np
import pytest

from sparkwright.llm import toxicity as T


def test_gradient():
    texts = [b"a bc def a", b"xx yy " * 9, "é ü ß".encode()]
    f = T.features(texts, 5, 2)
    w = T.new_weights(3, np.float64)
    up = np.random.default_rng(0).normal(size=len(f.doc))
    keep = {}
    T.logits(w, f, keep)
    g = T.gradients(w, f, keep, up)
    rng = np.random.default_rng(1)
    for name, v in w.items():
        flat = v.reshape(-1)
        used = np.flatnonzero(np.abs(g[name].reshape(-1)) > 0) if name in ("word", "trigram") else np.arange(flat.size)
        for i in rng.choice(used, min(6, len(used)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-5
            a = up @ T.logits(w, f)
            flat[i] = old - 1e-5
            b = up @ T.logits(w, f)
            flat[i] = old
            assert g[name].reshape(-1)[i] == pytest.approx((a - b) / 2e-5, rel=1e-4, abs=1e-8), name


def test_windows_cover_all_words():
    for n in (0, 1, 4, 5, 6, 7, 8, 23):
        f = T.features([b"x", " ".join(f"w{i}" for i in range(n)).encode(), b""], 5, 3)
        own = f.index[f.doc == 1]
        assert len(set(own[own < len(f.word)].tolist())) == n
        assert (f.doc == 2).sum() == 0 and (f.doc == 0).sum() == 1


def tables(spark, n=400):
    rng = np.random.default_rng(0)
    plain, bad = [f"{a}{b}" for a in ("ta", "ro", "mi", "ke", "su") for b in ("lo", "ni", "pa", "rem", "t")], ["grimlo", "grimt", "grimrem", "blagni"]
    rows, labels = [], []
    for i in range(n):
        w = rng.choice(plain, int(rng.integers(5, 120))).tolist()
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(1 + len(w) // 40):
                w[int(rng.integers(0, len(w)))] = str(rng.choice(bad))
        rows.append((i, " ".join(w), toxic))
        labels.append((i, 1, toxic))
    return (spark.createDataFrame(rows, "doc_id long, text string, toxic int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    got = {r.doc_id: r for r in T.score_toxicity(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_nulls_long_texts_and_no_labels(spark):
    docs, labels = tables(spark, 60)
    more = spark.createDataFrame([(None, None, 0), (7001, "", 0), (7002, " \n", 0), (7003, "talo " * 30000, 0), (1, "dup", 0)],
                                 "doc_id long, text string, toxic int")
    got = T.score_toxicity(docs.unionByName(more), labels).collect()
    assert len(got) == 65
    assert [r.score for r in got if r.doc_id in (7001, 7002) or r.doc_id is None] == [0.0, 0.0, 0.0]
    assert {r.score for r in T.score_toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert T.score_toxicity(docs.where("false"), labels).count() == 0


def test_scores_against_plain_loops():
    """A window's logit word by word, a document's score from its worst window, in runs of any length."""
    rng = np.random.default_rng(2)
    w = T.new_weights(4, np.float64) | {"shift": np.array([0.1])}
    texts = [" ".join(rng.choice(["ta", "Rolo", "né", "x9!", "grimlo"], n)).encode() for n in (0, 1, 5, 11, 60)]

    def word_input(word):
        f = T.features([word], 1, 1)
        return np.concatenate([w["word"][f.word[0]], w["trigram"][f.trigram].mean(axis=0)])

    def read(xs, side):
        h, states = np.zeros(T.HIDDEN), []
        for x in xs:
            p, u = x @ w[f"in_{side}"] + w[f"bias_{side}"], h @ w[f"rec_{side}"]
            r, z = (1 / (1 + np.exp(-(p + u)[a:a + T.HIDDEN])) for a in (0, T.HIDDEN))
            c = np.tanh(p[2 * T.HIDDEN:] + r * u[2 * T.HIDDEN:])
            h = z * h + (1 - z) * c
            states.append(h)
        return states

    want = []
    for text in texts:
        words = text.lower().split()
        top = -np.inf
        for at in range(0, max(1, len(words) - 8 + 3) if words else 0, 3):
            xs = [word_input(x) for x in words[at:at + 8]]
            if not xs:
                continue
            states = [np.concatenate(s) for s in zip(read(xs, "f"), read(xs[::-1], "b")[::-1])]
            e = np.exp([np.tanh(s @ w["att"] + w["att_bias"]) @ w["att_out"] for s in states])
            top = max(top, (e / e.sum()) @ np.array(states) @ w["out"] + w["out_bias"][0])
        want.append(top)
    old = T.RUN
    try:
        for T.RUN in (1, 4, 1 << 13):
            got = T.document_logits(w, texts, 8, 3)
            assert got[0] == -np.inf and np.allclose(got[1:], want[1:], atol=1e-9)
    finally:
        T.RUN = old
