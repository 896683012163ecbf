"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document is the set of its distinct shingles, ordered by rarity: by a count
sketch of all documents' shingles (a fixed number of counters), then by hash.
Two sets that reach the threshold share a token of their prefixes.

* Equal sets are one class; classes with the same prefix and size are one
  group, and only groups take part in the search.
* A posting list is all groups with a prefix token.  Length and positional
  bounds drop pairs that cannot reach the threshold.
* First each group meets the hubs of its posting lists (a few members picked by
  hash), so a list of m groups makes m pairs, not m squared.  Verified links
  are joined to components.
* Then only lists whose members are in different components are left.  All their
  pairs across components that aren't verified yet are expanded to classes and
  verified: so no link between components is lost, and links inside a component
  need not be looked at.  A parity bitmap of each set gives a lower bound of
  how many members two sets don't share; pairs beyond what the threshold allows
  are dropped inside the join, before they become rows.

Verification counts the common shingles (64-bit hashes) of the two whole sets.
Sets go through the shuffle only for classes with a candidate.

Null and empty texts have no shingles and are alone.  Rows with equal ids are
documents of their own; ``component_id`` is the least id that is not null.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import shared_dir

from .components import components
from .rows import numbered, release, saved, small
from .textops import U64, Batch, chunks, doc_ids, gram_hashes, mix

SKETCH_BITS, SKETCH_PARTS, HUBS = 20, 64, 64
#: Posting lists are made for a part of the tokens at a time, so that their shuffle files are not on disk together.
ROUNDS = 4
PARITY = 16            # longs of a set's parity bitmap
SETS = "row long, doc_id long, n long, s1 long, s2 long, bits array<long>, prefix array<long>"


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document (sorted within a document) and where each document begins."""
    batch = Batch(texts, lower=True)
    words, n_words = batch.hashes, batch.n_words
    grams, valid = gram_hashes(words, size), batch.gram_valid(size)
    doc = batch.word_doc[:len(grams)][valid]
    hashes = grams[valid]
    for n in range(1, size):                       # shorter texts: the whole sequence as one
        short = np.flatnonzero(n_words == n)
        if len(short):
            whole = gram_hashes(words, n)[batch.word_doc_starts[short]]
            hashes = np.concatenate([hashes, mix(whole + U64(n))])
            doc = np.concatenate([doc, short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    first = np.append(True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])) if len(doc) else np.empty(0, bool)
    hashes, doc = hashes[first], doc[first]
    return hashes, np.searchsorted(doc, np.arange(len(texts) + 1))


def rarity(docs: DataFrame, size: int) -> np.ndarray:
    """Counters of the shingles of all documents; their number is fixed, whatever the input."""
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for b in batches:
            for _, texts in chunks(b):
                hashes, _ = shingle_sets(texts, size)
                total += np.bincount((hashes >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        parts = [(i, zlib.compress(p.tobytes(), 1)) for i, p in enumerate(total.reshape(SKETCH_PARTS, width)) if p.any()]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()),
                                              pa.array([p for _, p in parts], pa.binary())], names=["part", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in t.column("counts").to_pylist())
        return pa.table({"part": t.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((SKETCH_PARTS, width), dtype=np.int64)
    schema = "part int, counts binary"
    for r in docs.select("text").mapInArrow(run, schema).groupBy("part").applyInArrow(add, schema).collect():
        out[r.part] = np.frombuffer(r.counts, np.int64)
    return out.reshape(-1)


def needed(n, percent: int):
    """The least overlap with any partner: ceil(percent * n / 100)."""
    return (n * percent + 99) // 100


def parity_bits(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A bitmap for each set in which each member flips a bit; (sets, PARITY) longs."""
    out = np.zeros((len(start) - 1, PARITY), dtype=U64)
    some = np.flatnonzero(np.diff(start))
    place = hashes >> U64(8)
    bit, word = U64(1) << (place & U64(63)), (place >> U64(6)) % U64(PARITY)
    for k in range(PARITY if len(some) else 0):
        out[some, k] = np.bitwise_xor.reduceat(np.where(word == U64(k), bit, U64(0)), start[some])
    return out


def _sets(shared, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for b in batches:
            for at, texts in chunks(b):
                hashes, start = shingle_sets(texts, size)
                n = np.diff(start)
                doc = np.repeat(np.arange(len(texts)), n)
                digests = [hashlib.blake2b(hashes[x:y].tobytes(), digest_size=16).digest() for x, y in zip(start, start[1:])]
                s = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                ordered = hashes[np.lexsort((hashes, counts[(hashes >> U64(64 - SKETCH_BITS)).astype(np.int64)], doc))]
                keep = np.where(n > 0, n - needed(n, percent) + 1, 0)
                inner = np.arange(len(hashes)) - np.repeat(start[:-1], n)
                prefix = ordered[inner < np.repeat(keep, n)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids(b, at, "row"), doc_ids(b, at), pa.array(n, pa.int64()), pa.array(s[:, 0]), pa.array(s[:, 1]),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * PARITY, pa.int32()),
                                              pa.array(parity_bits(hashes, start).view(np.int64).reshape(-1))),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(keep)), pa.int32()), pa.array(prefix))],
                    names=[c.split(" ")[0] for c in SETS.split(", ")])
    return run


def _verify(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (x, y) of rows whose whole sets reach the threshold."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in chunks(b):
                hashes, start = shingle_sets(texts, size)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids(b, at, "row"), pa.array([hashes[x:y].tobytes() for x, y in zip(start, start[1:])], pa.binary())],
                    names=["row", "shingles"])

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for p, q in zip(b.column("p"), b.column("q")):
                p, q = np.frombuffer(p.as_buffer(), U64), np.frombuffer(q.as_buffer(), U64)
                small, large = (p, q) if len(p) < len(q) else (q, p)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                same = int((large[at] == small).sum())
                keep.append(100 * same >= percent * (len(p) + len(q) - same))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y"), keep], names=["x", "y", "linked"])

    rows = saved(pairs.select(F.explode(F.array("x", "y")).alias("row")).distinct(), "asked")
    sets = saved(docs.select("row", "text").join(small(rows, "16"), "row").mapInArrow(whole, "row long, shingles binary"), "shingles")
    release(docs.sparkSession)
    return saved(pairs.join(sets.select(F.col("row").alias("x"), F.col("shingles").alias("p")), "x")
                 .join(sets.select(F.col("row").alias("y"), F.col("shingles").alias("q")), "y")
                 .select("x", "y", "p", "q").mapInArrow(common, "x long, y long, linked boolean"), "checked")


def _possible(percent: int, n: str, pos: str, m: str, at: str) -> str:
    """Length and positional bounds of two entries of a posting list: sizes n and m, places pos and at."""
    return (f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m}) and "
            f"{100 + percent} * (1 + least({n} - {pos} - 1, {m} - {at} - 1)) >= {percent} * ({n} + {m})")


def _few_differ(a: str, b: str, n: str, m: str, percent: int) -> str:
    """Members of one set alone flip bits: the bitmaps never differ in more bits than the sets in members."""
    differ = " + ".join(f"bit_count({a}[{k}] ^ {b}[{k}])" for k in range(PARITY))
    return f"{100 + percent} * ({differ}) <= {100 - percent} * ({n} + {m})"


def jaccard_components(documents: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, and ``row`` (its number in the scan)."""
    spark = documents.sparkSession
    shared_dir(spark)
    docs = numbered(documents, F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = spark.sparkContext.broadcast(rarity(docs, size))              # of a fixed size
    sets = saved(docs.mapInArrow(_sets(counts, size, percent), SETS)
                 .withColumn("g1", F.xxhash64("n", "prefix")).withColumn("g2", F.xxhash64("prefix", "n")), "sets")

    # A smaller set is linked with equal ones only.
    large = sets.where(f"100 * n >= {percent} * (n + 1)")
    groups = saved(large.groupBy("g1", "g2").agg(F.min("row").alias("g"), F.first("n").alias("n"), F.first("prefix").alias("prefix")), "groups")
    release(spark)
    classes = (large.groupBy("s1", "s2").agg(F.min("row").alias("cls"), F.first("g1").alias("g1"), F.first("g2").alias("g2"), F.first("n").alias("n"))
               .join(groups.select("g1", "g2", "g"), ["g1", "g2"]).select("cls", "g", "n"))
    pick = F.struct(F.xxhash64("g", F.col("token").bitwiseAND(HUBS - 1)), "g", "n", "pos")
    parts = []
    for k in range(ROUNDS):
        entries = (groups.select("g", "n", F.posexplode("prefix").alias("pos", "token"))
                   .where(F.pmod(F.shiftright("token", 8), F.lit(ROUNDS)) == k))
        hubs = (entries.groupBy("token").agg(F.count("*").alias("times"), F.min(pick).alias("hub"))
                .where("times > 1").select("token", F.col("hub.g").alias("h"), F.col("hub.n").alias("m"), F.col("hub.pos").alias("at")))
        parts.append(saved(entries.join(hubs, "token"), "lists"))
        release(spark)
    lists = reduce(DataFrame.unionByName, parts)

    # Each group with the hubs of its lists; each class with the first class of its group.
    stars = lists.where(f"g <> h and {_possible(percent, 'n', 'pos', 'm', 'at')}").select("g", "h").distinct()
    many = classes.where("cls <> g")
    tried = (classes.join(stars, "g").select(F.col("cls").alias("x"), F.col("h").alias("y"))
             .unionByName(many.select(F.col("cls").alias("x"), F.col("g").alias("y")))
             .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    checked = _verify(docs, saved(tried, "tried"), size, percent)
    links = checked.where("linked").select("x", "y")
    release(spark)
    label = saved(components(links), "label")
    release(spark)

    # What is left between components.
    named = (classes.join(label.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("c", F.coalesce("component", "cls")).select("cls", "g", "c", "n"))
    named = saved(named, "named")
    own = lists.select("token", "g", "pos").join(named, "g")
    open_ = own.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token")
    bits = sets.select(F.col("row").alias("cls"), "bits")
    left = own.join(open_, "token").join(bits, "cls").select("token", "cls", "c", "n", "pos", "bits")
    across = left.alias("a").join(left.alias("b"), F.expr(
        f"a.token = b.token and a.c < b.c and {_possible(percent, 'a.n', 'a.pos', 'b.n', 'b.pos')} and "
        f"{_few_differ('a.bits', 'b.bits', 'a.n', 'b.n', percent)}"))
    several = named.join(many.select("g").distinct(), "g").join(bits, "cls")
    same_group = (several.alias("a").join(several.alias("b"), F.expr(f"a.g = b.g and a.c < b.c and {_few_differ('a.bits', 'b.bits', 'a.n', 'b.n', percent)}"))
                  .select(F.col("a.cls").alias("x"), F.col("b.cls").alias("y")))
    rest = (across.select(F.col("a.cls").alias("x"), F.col("b.cls").alias("y")).unionByName(same_group)
            .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
            .join(checked.select("x", "y"), ["x", "y"], "left_anti"))
    rest = saved(rest, "rest")
    release(spark)
    late = _verify(docs, rest, size, percent).where("linked").select("x", "y")
    joined = components(links.unionByName(late)).withColumnRenamed("node", "cls")

    # Back to the documents.
    of_class = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("row").alias("cls"), F.min("doc_id").alias("least_id"))
    of_class = of_class.join(joined, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = of_class.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = of_class.join(least, "component").select("s1", "s2", "component_id", "component")
    return (sets.select("row", "doc_id", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "row", F.coalesce("component", "row").alias("first_row")))


def keep_one(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with all their columns, of each component the one with the smallest doc_id (then the first row)."""
    docs = numbered(documents, F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("doc"))
    found = jaccard_components(documents, size, percent)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    stay = found.groupBy("first_row").agg(F.min(order).alias("at")).select(F.col("at.row").alias("row"))
    return docs.join(stay, "row", "left_semi").select("doc.*")
