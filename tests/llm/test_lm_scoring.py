"""Language-model scores against plain counts."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkwright.llm.lm_scoring import Slice, build_filter, level_values, levels_of, pack_counts, score
from sparkwright.llm.textops import U64, mix


def fold(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t) + [None]


def brute(docs, strength):
    """Base and model scores with exact counts quantised as the filter's levels."""
    train = [fold(t) for i, t in docs if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    uni = Counter(w for d in train for w in d)
    pair = Counter(p for d in train for p in zip([None, *d], d))
    n, v = sum(uni.values()), len(uni)
    val = level_values()

    def q(c):
        return val[levels_of(np.array([c]))[0]] if c else 0.0

    out = []
    for i, t in docs:
        d = fold(t)
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in d)
        model = sum(math.log10((q(pair[(a, w)]) + strength * (q(uni[w]) + 1) / (n + v + 1)) / (q(uni[a]) + strength))
                    for a, w in zip([None, *d], d))
        out.append((i, held, len(d), sum(uni[w] > 0 for w in d), n, base, model))
    return out


def documents():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["É", "日本"]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(0, 60))).tolist())) for i in range(80)]
    return docs + [(90, None), (91, ""), (None, "w1 w2"), (3, docs[3][1]), (92, "A a B\tb\x0bc\n\n"), (93, "w1 w2 " * 4000)]


def test_levels_come_back():
    counts = np.array([1, 2, 3, 4, 7, 100, 10**6, 10**11])
    keys = mix(np.arange(len(counts), dtype=U64))
    keys.sort()
    bits = build_filter([(keys, counts), (keys, counts[::-1])])
    row = {"bucket": 0, "words": keys.tobytes(), "counts": pack_counts(counts)[0], "large": pack_counts(counts)[1], "filter": bits.tobytes()}
    s = Slice([row], 63, 0, 1)
    low = keys[keys >> U64(63) == 0]
    assert (s.level(low, 0) >= levels_of(counts[:len(low)])).all()
    assert s.exact(keys).tolist() == counts.tolist()
    assert (level_values()[levels_of(np.array([1, 2, 3]))] == [1, 2, 3]).all()
    misses = mix(np.arange(1000, 21000, dtype=U64)) >> U64(1)
    assert (s.level(misses, 0) > 0).mean() < 0.05


@pytest.mark.parametrize("max_bytes", [96 << 20, 2000])
def test_scores(spark, max_bytes):
    docs = documents()
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, row int").repartition(3)
    got = sorted(score(df, strength=20.0, max_bytes=max_bytes).collect(), key=repr)
    want = sorted(brute(docs, 20.0), key=lambda r: repr(r[:2]))
    by = {r[0]: r for r in want}
    assert len(got) == len(want)
    for g in got:
        w = by[g.doc_id]
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9)
        assert g.score >= w[6] - 1e-6 * abs(w[6]) - 0.4      # wrong hits of the filter mostly raise counts
        assert g.score == pytest.approx(w[6], rel=0.05)


def test_empty_and_untrained(spark):
    schema = "doc_id long, text string"
    assert score(spark.createDataFrame([], schema)).count() == 0
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = score(spark.createDataFrame([(i, "a b") for i in held], schema)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in rows} == {(0, 0, 0.0)}
