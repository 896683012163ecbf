"""Importance resampling: features, scores, selection and ranks against a plain loop."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from sparkwright.llm import resampling as R
from sparkwright.llm.queries import QUERIES
from sparkwright.llm.textops import Batch
from sparkwright.session import table

SCHEMA = "doc_id long, text string"


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, target):
    """Rows (doc_id, n_features, weight, score, rank) by the definition, as a sorted list."""
    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for b in features(text)[1]:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows, eligible = [], []
    for i, text in docs:
        n, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None])
        if n >= 20:
            eligible.append(rows[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(eligible[:25 * len(eligible) // 100], 1):
        r[4] = rank
    return ordered(rows)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, x or 0) for x in r])


def run(spark, docs, target, parts=3, **options):
    d = spark.createDataFrame(docs, SCHEMA).repartition(parts)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return ordered(R.resample(d, t, **options).drop("n_words").collect())


@pytest.mark.parametrize("finish", [4096, 5])
def test_whole_table(spark, finish):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    assert run(spark, docs, target, finish=finish) == brute(docs, target)
    if finish == 4096:
        assert ordered(QUERIES["op11_importance_resampling"](spark, sf_dir).collect()) == brute(docs, target)


def test_odd_rows(spark):
    rng = random.Random(5)
    words = ["Ab", "c9", "d", "é", "日本", "x" * 70, "y" * 64, "z" * 65]
    docs = [(i % 40 if i % 9 else None, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)]
    docs += [(7, None), (8, ""), (None, None), (9, "!?"), (10, "w " * 50_000), (11, "v" * 200_000), (7, docs[7][1]), (7, docs[7][1])]
    for finish in (4096, 3):
        assert run(spark, docs, ["Ab c9", None, "", "日本 d d"], finish=finish) == brute(docs, ["Ab c9", None, "", "日本 d d"])


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], ["a b"]) == [] and run(spark, [(1, "a b")], []) == brute([(1, "a b")], [])
    docs = [(i, "a b c d e f g h i j k l m n o p q r s t u " * (i + 1)) for i in range(9)]
    d = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in docs],
                              SCHEMA + ", row int, score string, weight int, rank int")
    t = spark.createDataFrame([("q", 3)], "text string, bucket int")
    assert ordered(R.resample(d, t).drop("n_words").collect()) == brute(docs, ["q"])


def test_checksums():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcxyz019éß", k=rng.choice([1, 2, 5, 30, 64, 65, 300]))) for _ in range(400)]
    batch = Batch([" ".join(words).encode()], "alnum")
    want = [zlib.crc32(w.encode()) for w in words]
    assert R.word_checksums(batch.buf, batch.starts, batch.ends).tolist() == want
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert R.Features(batch, 3, 1 << 31).bucket.tolist() == [zlib.crc32(r.encode()) % (1 << 31) for r in runs]


@pytest.mark.parametrize("kind", ["random", "ties", "sorted"])
def test_selection(spark, kind):
    rng = np.random.default_rng(3)
    n = 5000
    worse = {"random": rng.integers(-1000, 1000, n), "ties": np.zeros(n, int), "sorted": np.arange(n)}[kind]
    keys = [(int(w), int(i % 2), int(i % 7), i) for i, w in enumerate(worse)]
    df = spark.createDataFrame(keys, R.KEY_TYPES).repartition(5)
    want = sorted(keys)
    for k in (1, 2, 1250, 4999, 5000):
        assert R.cutoff(df, k, finish=2) == want[k - 1]
    assert R.cutoff(df, 0) is None and R.cutoff(df, n + 1) is None
