"""Links and components against all pairs."""
import numpy as np
import pytest

from sparkwright.llm.components import components
from sparkwright.llm.jaccard_join import jaccard_components, parity_bits


def sets_of(docs, size):
    out = []
    for t in docs:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        out.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def brute(ids, docs, size, percent):
    sets = sets_of(docs, size)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(docs)):
        least.setdefault(find(i), []).append(ids[i])
    return [(ids[i], len(s), min([x for x in least[find(i)] if x is not None], default=None) if s else ids[i])
            for i, s in enumerate(sets)]


def near_copies(rng):
    vocab = [f"w{i}" for i in range(300)] + ["É", "日本"]

    def text(n):
        return rng.choice(vocab, n).tolist()

    docs = []
    for base in [text(n) for n in (8, 20, 40, 80, 160)]:
        for _ in range(35):
            w = list(base)
            for _ in range(int(rng.integers(0, max(2, len(w) // 25)))):
                w[int(rng.integers(0, len(w)))] = str(rng.choice(vocab))
            docs.append(" ".join(w))
    passage = " ".join(text(30))
    docs += [passage + " " + " ".join(text(int(n))) for n in rng.integers(0, 12, 40)]
    # A chain: neighbours are linked, ends are not.
    long = text(400)
    docs += [" ".join(long[k * 12:k * 12 + 130]) for k in range(20)]
    return docs + [None, "", "a", "A", "a b", "a b c", "a  b\tC", "a b c d", "x y z q", docs[3], docs[3].upper(), " ".join(long * 30)]


@pytest.mark.parametrize("size,percent", [(4, 85), (2, 60)])
def test_all_pairs(spark, size, percent):
    docs = near_copies(np.random.default_rng(size))
    ids = [int(i) if i % 17 else None for i in np.random.default_rng(1).permutation(len(docs))]
    ids[5] = ids[6]
    df = spark.createDataFrame([(i, t, 9) for i, t in zip(ids, docs)], "doc_id long, text string, n int")
    got = jaccard_components(df, size, percent)
    assert sorted(map(repr, (tuple(r)[:3] for r in got.collect()))) == sorted(map(repr, brute(ids, docs, size, percent)))


def test_empty(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(3000, 3000)]
    perm = rng.permutation(5000)
    df = spark.createDataFrame([(int(perm[a]), int(perm[b])) for a, b in edges], "x long, y long")
    got = {r.node: r.component for r in components(df).collect()}
    path, star = [int(perm[i]) for i in range(201)], [int(perm[1000 + i]) for i in range(50)]
    assert got == {n: min(path) for n in path} | {n: min(star) for n in star}
    assert components(df.where("false")).count() == 0


def test_parity_is_a_lower_bound():
    rng = np.random.default_rng(7)
    for _ in range(200):
        a, b = (set(rng.integers(0, 400, int(rng.integers(1, 300))).tolist()) for _ in range(2))
        h = [np.array(sorted(s), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in (a, b)]
        bits = parity_bits(np.concatenate(h), np.array([0, len(a), len(a), len(a) + len(b)]))
        assert not bits[1].any()
        assert sum(int(x).bit_count() for x in bits[0] ^ bits[2]) <= len(a ^ b)
