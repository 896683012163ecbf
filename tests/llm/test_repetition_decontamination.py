"""Repeats and benchmark passages against brute force."""
import hashlib
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from sparkwright.llm import repetition as R
from sparkwright.llm.decontaminate import contamination
from sparkwright.llm.repetition import keep_good, longest_repeats, measure, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measure(text, min_repeat):
    w = WORD.findall(text or "")
    longest = [max([0] + [next((k for k in range(len(w) - max(i, j)) if w[i + k] != w[j + k]), len(w) - max(i, j))
                          for j in range(len(w)) if j != i]) for i in range(len(w))]
    inside = {m: len({q for i, n in enumerate(longest) if n >= m for q in range(i, i + (n if m != 5 else 5))}) for m in (5, min_repeat)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": dup, "n_repeat_words": inside[5], "n_covered": inside[min_repeat],
            "longest_repeat": max(longest, default=0)}


texts = st.lists(st.text(alphabet=" \n\tabé#日", max_size=60), max_size=5)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 9))
def test_measures(batch, min_repeat):
    got = measure([t.encode() for t in batch], min_repeat)
    for i, t in enumerate(batch):
        want = brute_measure(t, min_repeat)
        if min_repeat == 5:
            want.pop("n_covered")
        assert {k: int(got[k][i]) for k in want} == want


def test_one_word_many_times():
    n = 3000
    got = longest_repeats(np.zeros(n, dtype=np.uint64), n - np.arange(n))
    assert got.tolist() == [n - 1, *range(n - 1, 0, -1)]


DOCS = ["", None, "a b c", " ".join(f"w{i}" for i in range(50)), "x y z q r " * 40, " ".join(f"w{i % 60}" for i in range(120)),
        " ".join(f"v{i}" for i in range(20000)), "one line here\n" * 3 + " ".join(f"u{i}" for i in range(99))]


def test_quality_rows(spark):
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(DOCS * 2)] + [(None, DOCS[3], 1)], "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in quality(docs.repartition(2)).collect()}
    assert [got[i].kept for i in range(8)] == [False, False, False, True, False, False, True, True]
    assert got[4].base_failed and got[0].n_words == 0
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i in got if i is not None and got[i].kept)
    assert quality(docs.where("false")).count() == keep_good(docs.where("false")).count() == 0


def fold(t):
    return re.findall(r"[0-9a-z]+|[^\x00-\x7F]+", "") or re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute_hits(text, items, window):
    w, hit, found = fold(text), set(), set()
    for item, t in items:
        iw = fold(t)
        if item is None or not iw:
            continue
        n = min(window, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)}
        for p in range(len(w) - n + 1):
            if tuple(w[p:p + n]) in wins:
                hit.update(range(p, p + n))
                found.add(str(item))
    return (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))


@pytest.mark.parametrize("max_bytes", [4 << 20, 300])
@pytest.mark.parametrize("window", [10, 4])
def test_contamination(spark, max_bytes, window):
    rng = np.random.default_rng(3)
    word = [f"w{i}" for i in range(12)] + ["É", "日本", "X1"]

    def text(n):
        return " ".join(rng.choice(word, n).tolist())

    items = [(i, text(int(rng.integers(1, 25)))) for i in range(40)] + [(100, ""), (101, None), (None, "w1 w2"), (102, "w3 w3"),
                                                                        (7, "w1 w1 w1 w1"), (103, "..."), (104, "w5 w5 w5 w5 w5 w5 w5 w5 w5 w5 w5 w5")]
    docs = [(i, text(40) + (" " + items[i][1].replace(" ", ", ").upper() if i < 30 else "")) for i in range(60)]
    docs += [(200, None), (201, ""), (202, "w3. W3"), (None, items[3][1]), (3, docs[3][1]), (203, "w5 " * 3000)]
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, items string").repartition(3)
    got = contamination(d, b, window=window, max_bytes=max_bytes)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((i, *brute_hits(t, items, window))) for i, t in docs)
    assert contamination(d.where("false"), b).count() == 0
    assert {r.n_hit for r in contamination(d, b.where("false")).collect()} == {0}


def test_both_ways_to_the_common_prefixes(monkeypatch):
    """Words with many repeats, in several documents: from the kept levels and along the text."""
    rng = np.random.default_rng(9)
    for kinds, n in ((1, 300), (2, 500), (5, 800), (300, 600)):
        doc = np.sort(rng.integers(0, 4, n))
        symbols = (rng.integers(0, kinds, n) * 10 + doc).astype(np.uint64)
        ends = np.searchsorted(doc, doc, side="right")
        left = ends - np.arange(n)
        kept = R.longest_repeats(symbols, left)
        monkeypatch.setattr(R, "KEEP", 10)
        along = R.longest_repeats(symbols, left)
        monkeypatch.undo()
        want = [max((k for j in range(n) if j != i and doc[i] == doc[j]
                     for k in [next((x for x in range(min(left[i], left[j])) if symbols[i + x] != symbols[j + x]), min(left[i], left[j]))]), default=0)
                for i in range(n)] if n <= 300 else None
        assert kept.tolist() == along.tolist() and (want is None or kept.tolist() == want)


def test_twenty_megabytes_of_one_word():
    """Memory of a few numbers a word; the text is one repeat."""
    n = 5 << 20
    code = ("import resource, sparkwright.llm.repetition as R; "
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; "
            f"m = R.measure([b'abc ' * {n}], 8); "
            "print(m['longest_repeat'][0], m['n_covered'][0], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)")
    root = str(Path(R.__file__).parents[2])
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    longest, covered, kb = map(int, said.split())
    assert longest == n - 1 and covered == n and kb < 1000 << 10


def test_hashes_in_runs(monkeypatch):
    from sparkwright.llm import textops
    texts = [" ".join("w" * (1 + i % 40) for i in range(500)).encode(), b"xyz" * 1000 + b" y " + b"x" * 100 + b" " + b"x" * 101, b""]
    whole = textops.Batch(texts).hashes.copy()
    assert len(set(whole.tolist())) == len({w for t in texts for w in t.split()})
    monkeypatch.setattr(textops, "RUN_BYTES", 100)
    assert (textops.Batch(texts).hashes == whole).all()
