"""Personal data: patterns, and terms that disclose them by co-occurrence over the corpus.

Patterns (``BASE``) find e-mail and IP addresses, payment cards and telephone
numbers.  Each distinct value found is a protected entity c.

A term t (a word, lower-cased) discloses c as far as seeing t tells of c.  Over
the N documents of the corpus the information content of c is
``IC(c) = log2(N / n_c)``, the mutual information of t and c
``PMI(t; c) = log2(n_tc N / (n_t n_c))``, where n_c and n_t documents hold c and
t, and in n_tc of them t stands within ``reach`` words of c.  The disclosure is
PMI / IC: 1 if t never occurs without c, 0 if they are independent; the measure
is the same at every corpus size.  Terms that disclose some entity by
``generalise`` or more are spans of the kind ``term``, wherever they occur;
``sanitised`` puts a class of the word for them, and nothing from ``remove`` on.

Counts of one or two say little, and copies of a document say nothing new: a pair
counts only with ``support`` different neighbourhoods of the term (the two words
on either side).  Entities that stand in every document have no information.

Three passes over the texts, none of which shuffles them: the patterns and the
pairs near them; document counts of the terms in supported pairs; the places of
the disclosing terms.  The terms of interest go to the tasks as a bitmap of fixed
size (2^23 bits, 1 MB), and a join by the term's hash drops what only the bitmap
let through.  All counts are partial sums, so a common value or term is one row a
task; nothing is collected but the bitmap's buckets.

Null texts are empty and have no spans.  A null or repeated id is passed through;
equal rows are rows of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import scratch_path

from .rows import numbered
from .textops import U64, Batch, chunks, gram_hashes, mix

BASE = ("email", "ip", "card", "phone")
BITS = 1 << 23
_LOCAL = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(rb"[0-9]+")
_PHONE = re.compile(rb"[\x20().0-9-]*")


def emails(text: bytes) -> list[tuple[int, int]]:
    """An address is found from its @, so a long run of letters is walked once."""
    out, last, at = [], 0, text.find(b"@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        end = at + 1
        if begin < at and (m := _DOMAIN.match(text, end)):
            end = last = m.end()
            out.append((begin, end))
        at = text.find(b"@", end)
    return out


def _runs(text: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in _DIGITS.finditer(text)]


def ips(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Four runs of digits in a row with one dot between them; then on behind the fourth."""
    out, i = [], 0
    while i + 3 < len(runs):
        four = runs[i:i + 4]
        if all(b[0] - a[1] == 1 and text[a[1]] == 0x2E for a, b in zip(four, four[1:])):
            if all(_at_most_255(text[a:b]) for a, b in four):
                out.append((four[0][0], four[3][1]))
            i += 4
        else:
            i += 1
    return out


def _at_most_255(digits: bytes) -> bool:
    digits = digits.lstrip(b"0")
    return len(digits) <= 3 and int(digits or b"0") <= 255


def cards(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """All runs of digits that hang together by single spaces or hyphens are one match."""
    out, i = [], 0
    while i < len(runs):
        j, n = i, runs[i][1] - runs[i][0]
        while j + 1 < len(runs) and runs[j + 1][0] - runs[j][1] == 1 and text[runs[j][1]] in b" -":
            j += 1
            n += runs[j][1] - runs[j][0]
        if 13 <= n <= 19 and luhn(b"".join(text[a:b] for a, b in runs[i:j + 1])):
            out.append((runs[i][0], runs[j][1]))
        i = j + 1
    return out


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = (d - 48) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def phones(text: bytes) -> list[tuple[int, int]]:
    """A plus, a digit, something between, and the last digit of the run of number characters."""
    out, at = [], text.find(b"+")
    while at >= 0:
        end = at + 1
        if text[at + 1:at + 2].isdigit():
            run = _PHONE.match(text, at + 2).group()
            cut = len(run)
            while cut and not 48 <= run[cut - 1] <= 57:
                cut -= 1
            if cut >= 2:
                end = at + 2 + cut
                if 9 <= sum(48 <= c <= 57 for c in text[at + 1:end]) <= 15:
                    out.append((at, end))
        at = text.find(b"+", end)
    return out


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes, by kind and start."""
    runs = _runs(text)
    found = (emails(text) if b"@" in text else [], ips(text, runs), cards(text, runs), phones(text) if b"+" in text else [])
    return [(k, a, b) for k, spans in enumerate(found) for a, b in spans]


def entity(kind: int, value: bytes) -> int:
    """A number for the value, whatever its punctuation or case."""
    value = value.lower() if kind == 0 else b"".join(_DIGITS.findall(value)) if kind != 1 else value
    return int.from_bytes(hashlib.blake2b(b"%d:%b" % (kind, value), digest_size=8).digest(), "little", signed=True)


def _points(text: bytes) -> np.ndarray | None:
    """The code point at each byte and at the end; None if the text is ASCII (bytes are points)."""
    if text.isascii():
        return None
    first = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    return np.append(np.cumsum(first) - first, first.sum())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_PAIR = "struct<entity: long, term: long, near: long, is_first: int>"
_FOUND = ("row long, doc_id long, kinds array<int>, starts array<int>, ends array<int>, "
          f"entities array<long>, pairs array<{_PAIR}>")
_PAIR_TYPE = pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("near", pa.int64()), ("is_first", pa.int32())])


def _free_words(spans: list[tuple[int, int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for the words that no base span touches."""
    free = np.ones(len(starts), dtype=bool)
    for _, a, b in spans:
        free[np.searchsorted(ends, a, side="right"):np.searchsorted(starts, b, side="left")] = False
    return free


def _pairs(text: bytes, spans, starts, ends, hashes, reach: int) -> list[dict]:
    """The terms within reach of each span, with the neighbourhood they stand in, once each."""
    free = np.flatnonzero(_free_words(spans, starts, ends))
    if not len(free):
        return []
    words = hashes[free]
    # two words on either side; places beyond the text count as nothing
    padded = np.concatenate([np.zeros(2, U64), words, np.zeros(2, U64)])
    around = np.stack([padded[:-4], padded[1:-3], padded[3:-1], padded[4:]], axis=1)
    near = mix(around[:, 0] * U64(3) ^ mix(around[:, 1] * U64(5) ^ mix(around[:, 2] * U64(7) ^ mix(around[:, 3] + U64(9)))))
    seen, out = {}, []
    terms, nears = _signed(words), _signed(near)
    lefts = np.searchsorted(ends[free], [a for _, a, _ in spans], side="right").tolist()
    rights = np.searchsorted(starts[free], [b for _, _, b in spans], side="left").tolist()
    for (kind, a, b), left, right in zip(spans, lefts, rights):
        c = entity(kind, text[a:b])
        for i in (*range(max(0, left - reach), left), *range(right, min(len(free), right + reach))):
            t, where = int(terms[i]), int(nears[i])
            places = seen.setdefault((c, t), set())
            if where not in places:
                out.append({"entity": c, "term": t, "near": where, "is_first": int(not places)})
                places.add(where)
    return out


def _find(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in chunks(b):
                batch = Batch(texts, "alnum", lower=True)
                kinds, starts, ends, entities, pairs = ([] for _ in range(5))
                for d, text in enumerate(texts):
                    spans = base_spans(text)
                    points = _points(text) if spans else None
                    kinds.append([k for k, _, _ in spans])
                    starts.append([int(a if points is None else points[a]) for _, a, _ in spans])
                    ends.append([int(e if points is None else points[e]) for _, _, e in spans])
                    entities.append(sorted({entity(k, text[a:e]) for k, a, e in spans}))
                    if spans:
                        w = slice(batch.word_doc_starts[d], batch.word_doc_starts[d + 1])
                        pairs.append(_pairs(text, spans, batch.starts[w] - batch.doc_starts[d],
                                            batch.ends[w] - batch.doc_starts[d], batch.hashes[w], reach))
                    else:
                        pairs.append([])
                here = slice(at.start, at.stop)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(here.start, len(texts)), b.column("doc_id").slice(here.start, len(texts)),
                     *(pa.array(x, pa.list_(pa.int32())) for x in (kinds, starts, ends)),
                     pa.array(entities, pa.list_(pa.int64())), pa.array(pairs, pa.list_(_PAIR_TYPE))],
                    names=["row", "doc_id", "kinds", "starts", "ends", "entities", "pairs"])
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _bitmap(terms: DataFrame) -> np.ndarray:
    """One bit for each term's hash modulo ``BITS``; at most 256 buckets of 4 KB reach the driver."""
    bit = F.pmod("term", F.lit(BITS)).cast("long") + 1      # buckets and places count from 1
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in (terms.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()):
        first = (r.bucket - 1) * 4096
        out[first:first + 4096] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return out


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = np.mod(_signed(hashes), BITS)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _document_counts(docs: DataFrame, shared) -> DataFrame:
    """``term``, ``n_t``: documents that hold each marked term outside base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for b in batches:
            for _, texts in chunks(b):
                doc, _, _, hashes = _marked_words(texts, bitmap)
                pairs = np.unique(np.stack([doc.astype(U64), hashes], axis=1), axis=0)
                term, n = np.unique(pairs[:, 1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.ascontiguousarray(term))), pa.array(n, pa.int64())], names=["term", "n"])

    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))


def _marked_words(texts: list[bytes], bitmap: np.ndarray):
    """(document, start, end, hash) of the marked words that no base span touches, in bytes of the document."""
    batch = Batch(texts, "alnum", lower=True)
    some = np.flatnonzero(_marked(bitmap, batch.hashes))
    doc = batch.word_doc[some]
    starts, ends = batch.starts[some] - batch.doc_starts[doc], batch.ends[some] - batch.doc_starts[doc]
    keep = np.ones(len(some), dtype=bool)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d in np.unique(doc):
        if spans := base_spans(texts[d]):
            own = slice(edges[d], edges[d + 1])
            keep[own] = _free_words(spans, starts[own], ends[own])
    return doc[keep], starts[keep], ends[keep], batch.hashes[some[keep]]


def _places(docs: DataFrame, shared) -> DataFrame:
    """``row, term, start, end`` in code points of the marked words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for b in batches:
            rows = b.column("row").to_numpy(zero_copy_only=False)
            for at, texts in chunks(b):
                doc, starts, ends, hashes = _marked_words(texts, bitmap)
                edges = np.searchsorted(doc, np.arange(len(texts) + 1))
                for d in np.unique(doc):
                    points, own = _points(texts[d]), slice(edges[d], edges[d + 1])
                    if points is not None:
                        starts[own], ends[own] = points[starts[own]], points[ends[own]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[at.start + doc]), pa.array(_signed(hashes)), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                    names=["row", "term", "start", "end"])

    return docs.mapInArrow(run, "row long, term long, start int, end int")


def disclosures(found: DataFrame, docs: DataFrame, n_docs: int, support: int, generalise: float) -> DataFrame:
    """``term``, ``disclosure``: the largest PMI / IC of each term over the entities it stands with."""
    spark = docs.sparkSession
    pair = found.select(F.explode("pairs").alias("p")).select("p.*")
    n_tc = (pair.groupBy("entity", "term", "near").agg(F.sum("is_first").alias("n"))
            .groupBy("entity", "term").agg(F.sum("n").alias("n_tc"), F.count("*").alias("support"))
            .where(F.col("support") >= support))
    # written, so that a join can split an entity with many terms and a term with many entities
    n_c = _written(found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_c"))
                   .where(F.col("n_c") < n_docs), "entities")
    pairs = _written(n_tc.join(n_c, "entity"), "pairs")
    n_t = _written(_document_counts(docs, spark.sparkContext.broadcast(_bitmap(pairs))), "term-counts")
    n = F.lit(float(n_docs))
    ratio = F.log2(F.col("n_tc") * n / (F.col("n_t") * F.col("n_c"))) / F.log2(n / F.col("n_c"))
    return (pairs.join(n_t, "term").groupBy("term").agg(F.max(ratio).alias("disclosure"))
            .where(F.col("disclosure") >= generalise))


def find_spans(documents: DataFrame, reach: int = 8, support: int = 3, generalise: float = 0.8) -> DataFrame:
    """``row, doc_id`` and ``spans``: (kind, start, end, disclosure) of each document.

    Base spans come first, by kind and start, with a null disclosure; then the terms by start.
    """
    return _spans(numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text"), reach, support, generalise)


def _spans(docs: DataFrame, reach: int, support: int, generalise: float) -> DataFrame:
    spark = docs.sparkSession
    found = _written(docs.mapInArrow(_find(reach), _FOUND), "found")
    terms = _written(disclosures(found, docs, found.count(), support, generalise), "terms")
    places = (_places(docs, spark.sparkContext.broadcast(_bitmap(terms))).join(terms, "term").groupBy("row")
              .agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("words")))
    names = F.array(*map(F.lit, (*BASE, "term")))
    base = F.transform(F.arrays_zip("kinds", "starts", "ends"), lambda x: F.struct(
        F.element_at(names, x["kinds"] + 1).alias("kind"), x["starts"].alias("start"), x["ends"].alias("end"),
        F.lit(None).cast("double").alias("disclosure")))
    more = F.transform("words", lambda x: F.struct(
        F.lit("term").alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["disclosure"].alias("disclosure")))
    return found.join(places, "row", "left").select(
        "row", "doc_id", F.concat(base, F.coalesce(more, F.array().cast(
            "array<struct<kind: string, start: int, end: int, disclosure: double>>"))).alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans and all spans as ``kind:start:end``, for each document."""
    base = F.filter("spans", lambda s: s["kind"] != "term")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text(x):
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return spans.select(
        "doc_id", *map(count, BASE),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def generalised(word: str) -> str:
    """The class that stands for a disclosing word."""
    return "[number]" if word.isdigit() else "[code]" if any(c.isdigit() for c in word) else \
        "[name]" if word[:1].isupper() else "[word]"


def sanitised(documents: DataFrame, reach: int = 8, support: int = 3, generalise: float = 0.8,
              remove: float = 0.95) -> DataFrame:
    """The documents with clean texts: ``[kind]`` for base spans, a class or nothing for disclosing terms.

    Overlapping base spans become one, named by the first.  A null text stays null.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("document")
    docs = numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text", whole)
    spans = _spans(docs.select("row", "doc_id", "text"), reach, support, generalise).select("row", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            document, new = b.column("document"), []
            texts = document.field("text")
            for text, found in zip(texts.to_pylist(), b.column("spans").to_pylist()):
                if text is not None:
                    parts, last = [], 0
                    for s in sorted(found or [], key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= last:
                            parts.append(text[last:s["start"]])
                            if s["kind"] != "term":
                                parts.append(f"[{s['kind']}]")
                            elif s["disclosure"] < remove:
                                parts.append(generalised(text[s["start"]:s["end"]]))
                        last = max(last, s["end"])
                    text = "".join(parts) + text[last:]
                new.append(text)
            names = [f.name for f in document.type]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, texts.type) if c == "text" else x for c, x in zip(names, document.flatten())], names=names)

    return docs.select("row", "document").join(spans, "row", "left").mapInArrow(run, documents.schema)
