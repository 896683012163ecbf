"""Personal data: patterns against the plain regular expressions, disclosures against a plain count."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkwright.llm import sanitise as S
from sparkwright.llm.queries import QUERIES
from sparkwright.llm.textops import Batch
from sparkwright.session import table

SCHEMA = "doc_id long, text string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    double = {c: str(int(c) * 2 - 9 * (int(c) > 4)) for c in "0123456789"}
    return sum(int(double[c] if k % 2 else c) for k, c in enumerate(reversed(digits))) % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in found.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def patterns(text):
    """(kind, start, end) by the regular expressions."""
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m.group())]


def found(text):
    """The same by the operator, in code points."""
    raw = text.encode()
    return [(S.BASE[k], len(raw[:a].decode()), len(raw[:b].decode())) for k, a, b in S.base_spans(raw)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@+-0123 ()é%\n", max_size=60))
def test_patterns_on_odd_texts(text):
    assert found(text) == patterns(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "+1 (212) 555-0100", "10.0.0.255", "1.2.3.256", "a.b@c.d.e", "@", "x@y",
                                 "+", " ", "-", ".", "4111-1111-1111-1112", "00000000000000", "é", "+44 20 7946 0958 ", "0"]), max_size=12))
def test_patterns_in_a_row(parts):
    text = "".join(parts)
    assert found(text) == patterns(text)


def test_patterns_on_the_documents(spark):
    for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect():
        assert found(r.text) == patterns(r.text)


@pytest.mark.parametrize("text", ["a" * 3_000_000, "1" * 3_000_000, "1." * 1_500_000, "a@" * 1_000_000, "+1 " * 700_000, "+1" + " " * 2_000_000])
def test_long_runs_take_linear_time(text):
    assert all(S.BASE[k] == "ip" for k, _, _ in S.base_spans(text.encode()))


def test_many_spans_in_one_text():
    """Work follows the words and spans, not their product."""
    text = ("word here a@b.cc " * 100_000).encode()
    batch = Batch([text], "alnum", lower=True)
    spans = S.base_spans(text)
    got = S._pairs(text, spans, batch.starts, batch.ends, batch.hashes, 8)
    assert len(spans) == 100_000 and {(p["entity"]) for p in got} == {S.entity(0, b"a@b.cc")}


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def value(kind, text):
    return kind, text.lower() if kind == "email" else text if kind == "ip" else re.sub("[^0-9]", "", text)


def brute(docs, reach=8, support=3, generalise=0.8):
    """All rows (doc_id, base spans, term spans) by counting pairs in plain loops."""
    near, n_tc, n_c, n_t, parts = defaultdict(set), defaultdict(int), defaultdict(int), defaultdict(int), []
    for i, text in docs:
        text = text or ""
        base = patterns(text)
        free = [w for w in words(text) if all(w[2] <= a or w[1] >= b for _, a, b in base)]
        parts.append((i, base, free))
        for t in {w[0] for w in free}:
            n_t[t] += 1
        for c in {value(k, text[a:b]) for k, a, b in base}:
            n_c[c] += 1
        own, names = set(), ["", "", *(w[0] for w in free), "", ""]
        for k, a, b in base:
            left = [j for j, w in enumerate(free) if w[2] <= a][-reach:]
            right = [j for j, w in enumerate(free) if w[1] >= b][:reach]
            for j in left + right:
                pair = value(k, text[a:b]), free[j][0]
                near[pair].add((names[j], names[j + 1], names[j + 3], names[j + 4]))
                own.add(pair)
        for pair in own:
            n_tc[pair] += 1
    n, terms = len(docs), {}
    for (c, t), where in near.items():
        if len(where) >= support and n_c[c] < n:
            d = math.log2(n_tc[c, t] * n / (n_t[t] * n_c[c])) / math.log2(n / n_c[c])
            if d >= generalise:
                terms[t] = max(d, terms.get(t, 0))
    return terms, [(i, base, [("term", w[1], w[2]) for w in free if w[0] in terms]) for i, base, free in parts]


def digest(rows):
    def text(spans):
        return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return sorted(((i, *(sum(k == b[0] for b in base) for k in PATTERNS), hashlib.sha256(text(base).encode()).hexdigest(),
                    text(base + more)) for i, base, more in rows), key=lambda r: [(x is None, x or 0) for x in r[:1]] + [str(r)])


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: [(x is None, x or 0) for x in r[:1]] + [str(r)])


def people():
    """Two names that betray an address, one that stands elsewhere too, and copies that say nothing new."""
    rng = random.Random(2)
    filler = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]

    def some(n=6):
        return " ".join(rng.choices(filler, k=n))
    docs = [f"{some()} Quill writes to q.fox@mail.example.com {some()}" for _ in range(6)]
    docs += [f"{some()} call Zénon on +1 (212) 555-0100 {some()}" for _ in range(5)]
    docs += [f"{some()} common 10.1.2.3 {some()}" for _ in range(4)] + [f"{some()} common {some()}" for _ in range(20)]
    docs += ["one Hapax stands by 4111 1111 1111 1111 here"] * 9
    docs += [f"Quill was here, {some(9)}" for _ in range(2)] + [some(30) for _ in range(30)]
    return list(enumerate(docs))


def test_disclosing_terms(spark):
    docs = people()
    terms, rows = brute(docs)
    assert {"quill", "zénon"} <= set(terms) and not {"common", "hapax", "alpha"} & set(terms)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    assert got(S.digest(S.find_spans(df))) == digest(rows)
    clean = {r.doc_id: r.text for r in S.sanitised(df).collect()}
    assert "[name] writes" not in docs[0][1] and "q.fox" not in clean[0] and "[email]" in clean[0] and "Quill" not in clean[0]
    assert "Zénon" not in clean[6] and "[phone]" in clean[6] and clean[11].replace("[ip]", "10.1.2.3") == docs[11][1]
    assert "Quill" not in clean[len(docs) - 32] and clean[len(docs) - 1] == docs[-1][1]


@pytest.mark.parametrize("support, generalise", [(1, 0.5), (2, 0.8), (3, 0.3)])
def test_made_corpora(spark, support, generalise):
    rng = random.Random(support)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "naïve", "日本"]
    data = ["a@b.cc", "c@d.ee", "10.0.0.1", "+1 (212) 555-0100", "4111 1111 1111 1111"]
    docs = [(i % 50, " ".join(rng.choices(vocabulary, k=rng.randint(0, 25)) + rng.choices(data, k=rng.randint(0, 2))
             + rng.choices(vocabulary, k=rng.randint(0, 9)))) for i in range(120)]
    docs += [(None, None), (3, ""), (3, ""), (None, "a@b.cc"), (4, "a@b.cc " * 300), docs[0], docs[0]]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert got(S.digest(S.find_spans(df, support=support, generalise=generalise))) == digest(brute(docs, 8, support, generalise)[1])


def test_whole_table(spark):
    docs = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    assert got(QUERIES["op12_disclosure_sanitisation"](spark, "/root/testdata/sf0.001")) == digest(brute(docs)[1])


def test_empty_table_and_clashing_columns(spark):
    assert S.digest(S.find_spans(spark.createDataFrame([], SCHEMA))).collect() == []
    docs = people()
    df = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in docs] + [(None, None, None, None, None, None)],
                               SCHEMA + ", row int, spans string, term int, `odd.name` int")
    out = S.sanitised(df)
    assert out.columns == df.columns and sorted(r.row for r in out.collect() if r.row) == [1] * len(docs)
    assert got(S.digest(S.find_spans(df))) == digest(brute([*docs, (None, None)])[1])
