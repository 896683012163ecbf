"""Packing and token counts against the tokenizer libraries."""
import zlib
from functools import cache

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st

from sparkwright.llm.packing import Encoder, Packer, pack
from sparkwright.llm.token_counts import Merger, count_tokens

ODD = ["", " ", "a", "  a  b ", "a\n \nb\t c", "x<|endoftext|> y", "<s> </s> <unk>", "▁a ▁▁b", "\x00\x7f", "né ñ ß 日本 🙂",
       "aaaa" * 300, "word " * 5000, "\n" * 50, "ab   c", "Don't we'll 12,345.6 !!?"]


@pytest.fixture(scope="module")
def enc():
    return Encoder(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def mer():
    return Merger(P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def piece():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def test_fast_encoder_in_use(enc):
    assert enc.fast is not None


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(enc, mer, piece, text):
    assert enc.encode(text).tolist() == enc.full.encode(text, add_special_tokens=False).ids
    assert mer.count(text) == len(piece.encode(text))


@pytest.mark.parametrize("text", [" " * 1_000_000 + "a", "a" + " \n" * 300_000, "b" * 300_000, "\u3000" * 120_000 + "x", "x" + " " * 99_999 + "y"])
def test_long_runs(enc, text):
    """The fast encoder ends the process on a million spaces; such texts go through the library."""
    assert enc.encode(text).tolist() == enc.full.encode(text, add_special_tokens=False).ids


@cache
def libraries():
    import sentencepiece
    return (Encoder(P.path("byte_bpe_50k.json")), Merger(P.path("piece_bpe_32k.model")),
            sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]),
                                  st.sampled_from(" \n\tabcdehilnorst.,▁")), max_size=60))
def test_any_text(text):
    e, m, p = libraries()
    assert e.encode(text).tolist() == e.full.encode(text, add_special_tokens=False).ids
    assert m.count(text) == len(p.encode(text))


def test_level_choice_is_the_least_sum_of_squares():
    rng = np.random.default_rng(1)
    p = Packer(16, 10**6)
    for d in range(400):
        size = int(rng.integers(1, 16))
        best = {}
        for level in range(0, 17 - size):
            if level and not p.levels[level]:
                continue
            n = p.levels.copy()
            if level:
                n[level] -= 1
            if level + size < 16:
                n[level + size] += 1
            best[level] = int((n * n).sum())
        got = p.place(size)
        assert best[got] == min(best.values())
        list(p.add(d, np.arange(size, dtype="<u4")))
        assert sum(len(b) for b in p.open.values()) == p.n_open == p.levels.sum()


def rows(spark):
    return spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(ODD + ["some words again " * 3000, None, ODD[9], ODD[9]])] + [(None, "a b", "y", 2)],
        "doc_id long, text string, sequence_id string, offset int")


def test_pack_is_a_partition_of_all_ids(spark, enc):
    got = pack(rows(spark).repartition(3)).toPandas()
    for doc, text, *_ in rows(spark).collect():
        want = np.append(enc.encode(text or ""), 1).astype("<u4")
        own = got[got.doc_id.isna() if doc is None else got.doc_id == doc].sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() == len(want) == own.doc_tokens.iloc[0]
        for s, n, c in zip(own.start, own.length, own.ids_crc32):
            assert zlib.crc32(want[int(s):int(s + n)].tobytes()) == c
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *seq.length.cumsum().tolist()[:-1]]
        total = int(seq.length.sum())
        assert total <= 2048 and total & (total - 1) == 0     # no padding at all


def test_a_bounded_packer_loses_nothing(spark):
    a = pack(rows(spark).coalesce(1), max_open=2).toPandas()
    b = pack(rows(spark).coalesce(1)).toPandas()
    assert a.length.sum() == b.length.sum()


def test_counts(spark, piece):
    got = count_tokens(rows(spark), limit=50).collect()
    want = {(d, t): len(piece.encode(t or "")) for d, t, *_ in rows(spark).collect()}
    assert sorted((r.n_tokens for r in got)) == sorted(want.values())
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)
    assert {r.doc_id: r.n_bytes for r in got}[9] == len(ODD[9].encode())


def test_empty_tables(spark):
    empty = rows(spark).where("false")
    assert pack(empty).count() == count_tokens(empty).count() == 0
