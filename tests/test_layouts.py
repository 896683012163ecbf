"""Keyed tables, lookup files, bucket folders, manifests and stored ranges."""

import datetime
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import boundaries as B
from sparkwright.operators import ordering as O
from sparkwright.session import scratch_path
from sparkwright.sinks import manifest
from sparkwright.sinks.keyed import KeyedTable
from sparkwright.sinks.numbered_files import BucketFolders, LookupFile

CELL = "key string, at int, v string"


def cells(seed, n=300):
    rng = random.Random(seed)
    return [(f"k{rng.randint(0, 120):03d}", rng.randint(0, 5), f"{seed}.{i}") for i in range(n)]


def newest(loads):
    best = {}
    for run, rows in enumerate(loads):
        for k, at, v in rows:
            best.setdefault(k, []).append((at, run, v))
    return {k: {v for a, r, v in own if (a, r) == max(x[:2] for x in own)} for k, own in best.items()}


def same(df, want):
    rows = df.collect()
    return len(rows) == len(want) and all(r.v in want[r.key] for r in rows)


@pytest.fixture()
def keyed(spark):
    return KeyedTable.create(spark, scratch_path(spark, "t"), spark.createDataFrame([], CELL).schema, "key", "at", ["k030", "k060", "k090"])


def test_three_loads_make_one_table(spark, keyed):
    loads = [cells(i) for i in range(3)]
    frames = [spark.createDataFrame(rows, CELL).repartition(3) for rows in loads]
    keyed.load_bulk(frames[0])
    keyed.load_direct(frames[1])
    keyed.load_rows(loads[2])
    want = newest(loads)
    assert same(keyed.read(), want) and keyed.runs() == [[1, 2, 3]] * 4
    keyed.compact([1])
    assert same(keyed.read(), want) and keyed.runs()[1] == [4] and keyed.runs()[0] == [1, 2, 3]
    keyed.compact()
    assert same(keyed.read(), want) and keyed.runs() == [[5]] * 4
    loads.append([("k005", 9, "new"), ("zz", 0, "last"), ("", 0, "first")])
    keyed.load_rows(loads[-1])
    want = newest(loads)
    assert same(keyed.read(), want) and keyed.get("k005").first().v == "new" and keyed.get("nobody").count() == 0
    keyed.recut(7)
    assert same(keyed.read(), want) and len(keyed.runs()) == 7
    assert keyed.vacuum() == [1, 2, 3, 4, 5, 6] and same(keyed.read(), want)


def test_kinds_of_load_agree(spark):
    tables = []
    for kind in ("load_rows", "load_direct", "load_bulk"):
        t = KeyedTable.create(spark, scratch_path(spark, kind), spark.createDataFrame([], CELL).schema, "key", "at", ["k050"])
        for i in range(2):
            getattr(t, kind)(spark.createDataFrame([(k, at, k + str(at)) for k, at, _ in cells(i)], CELL).repartition(2))
        tables.append(sorted(map(tuple, t.read().collect())))
    assert tables[0] == tables[1] == tables[2]


def test_range_read_opens_its_regions(spark, keyed):
    rows = cells(1)
    keyed.load_bulk(spark.createDataFrame(rows, CELL))
    want = {k: v for k, v in newest([rows]).items() if "k040" <= k <= "k070"}
    got = keyed.read("k040", "k070")
    assert same(got, want)
    assert {f.split("region=")[1][0] for f in got.inputFiles()} == {"1", "2"}
    keyed.compact()
    assert "Aggregate" not in keyed.read()._jdf.queryExecution().executedPlan().toString()


def test_failed_load_leaves_nothing(spark, keyed):
    keyed.load_rows([("a", 1, "x")])
    with pytest.raises(Exception, match="null key or version"):
        keyed.load_rows([("b", 1, "y"), (None, 1, "z")])
    assert [tuple(r) for r in keyed.read().collect()] == [("a", 1, "x")]
    keyed.load_rows([("b", 2, "w")])
    assert sorted(tuple(r) for r in keyed.read().collect()) == [("a", 1, "x"), ("b", 2, "w")]


def test_empty_table_and_taken_names(spark, keyed):
    assert keyed.read().collect() == [] and keyed.read("a", "b").collect() == []
    keyed.compact()
    assert keyed.read().collect() == []
    keyed.recut(3)
    assert keyed.read().columns == ["key", "at", "v"] and keyed.runs() == [[2]]
    with pytest.raises(ValueError):
        KeyedTable.create(spark, scratch_path(spark, "x"), spark.createDataFrame([], "key string, at int, run int").schema, "key", "at")


def test_manifest(spark):
    path = scratch_path(spark, "m")
    with pytest.raises(FileNotFoundError):
        manifest.latest(spark, path)
    manifest.commit(spark, path, 0, {"a": [1, "é"]})
    manifest.commit(spark, path, 10, {"a": 2})
    assert manifest.versions(spark, path) == [0, 10] and manifest.latest(spark, path) == (10, {"a": 2})
    assert manifest.read(spark, path, 0) == {"a": [1, "é"]}
    with pytest.raises(FileExistsError):
        manifest.commit(spark, path, 10, {})


def test_lookup_opens_one_file(spark):
    rows = [(i % 50 if i % 3 else 7, f"v{i}") for i in range(3000)] + [(None, "null")]
    df = spark.createDataFrame(rows, "k long, v string").repartition(4)
    t = LookupFile.write(df, "k", scratch_path(spark, "l"), 8)
    for key in (7, 8, 49, 50, -3):
        got = t.get(key)
        assert sorted(r.v for r in got.collect()) == sorted(v for k, v in rows if k == key)
        assert len(got.inputFiles()) <= 1
        assert "PushedFilters: [IsNotNull(k), EqualTo(k" in got._jdf.queryExecution().executedPlan().toString() or not got.inputFiles()
    assert t.get(None).collect() == []
    keys = spark.createDataFrame([(7,), (9,), (9,), (99,), (None,)], "k int")
    got = t.get_all(keys)
    assert sorted(map(tuple, got.collect())) == sorted((k, v) for k, v in rows if k in (7, 9))
    assert t.get_all(keys.where("k = -1")).collect() == []


def test_lookup_by_text_and_by_date(spark):
    day = datetime.date(2024, 2, 29)
    df = spark.createDataFrame([("é'x", day, 1), ("b", day, 2), ("b", None, 3)], "s string, d date, n int")
    assert LookupFile.write(df, "s", scratch_path(spark, "l"), 5).get("é'x").first().n == 1
    assert sorted(r.n for r in LookupFile.write(df, "d", scratch_path(spark, "l"), 5).get(day).collect()) == [1, 2]
    with pytest.raises(ValueError):
        LookupFile.write(df.withColumn("file", F.lit(1)), "s", scratch_path(spark, "l"), 5)


@pytest.mark.parametrize("of, files", [(8, 1), (4, 2), (2, 4), (1, 8), (16, 1), (3, 8)])
def test_bucket_sample_reads_its_share(spark, of, files):
    df = spark.range(-200, 200).withColumn("t", F.col("id").cast("string")).unionByName(spark.createDataFrame([(None, None)], "id long, t string"))
    t = BucketFolders.write(df.coalesce(1), "id", scratch_path(spark, "b"), 8)
    seen = []
    for bucket in range(1, of + 1):
        got = t.sample(bucket, of)
        assert len({f.split("file=")[1][0] for f in got.inputFiles()}) == files
        ids = [r.id for r in got.collect()]
        assert all(i % of == bucket - 1 for i in ids)
        seen += ids
    assert sorted(seen) == list(range(-200, 200))
    with pytest.raises(ValueError):
        t.sample(of + 1, of)


def test_bucket_sample_of_text(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("t"))
    t = BucketFolders.write(df, "t", scratch_path(spark, "b"), 4)
    assert sorted(r.t for b in (1, 2, 3, 4) for r in t.sample(b, 4).collect()) == sorted(str(i) for i in range(300))


@pytest.mark.parametrize("kind", ["random", "sorted", "reverse", "skew"])
def test_sketch_ranks(kind):
    rng = np.random.default_rng(1)
    n, parts = 200_000, 20
    keys = {"random": rng.random(n), "sorted": np.arange(n) * 1.0, "reverse": -np.arange(n) * 1.0, "skew": rng.random(n) ** 8}[kind]
    sketch, states = B.QuantileSketch(parts, "double"), []
    for part in np.array_split(keys, 13):
        states.append(sketch.init())
        for batch in np.array_split(part, 7):
            states[-1] = sketch.iterate(states[-1], pa.array(batch))
    state = sketch.from_bytes(sketch.to_bytes(states[0]))
    for s in states[1:]:
        state = sketch.merge(state, s)
    assert sum(map(len, state["levels"])) <= 14 * sketch.size
    sizes = np.bincount(np.searchsorted(sketch.terminate(state), keys, side="left"), minlength=parts)
    assert len(sizes) == parts and sizes.max() <= 1.2 * n / parts


def test_cuts_of_odd_keys(spark):
    for rows, kind in (([("b",), ("a",), (None,), ("é",), ("b",)], "string"), ([(datetime.date(2020, 1, d),) for d in range(1, 9)], "date"),
                       ([], "int"), ([(None,)], "int"), ([(3,)] * 50, "int")):
        df = spark.createDataFrame(rows, f"k {kind}")
        cuts = B.range_cuts(df, "k", 4)
        assert cuts == sorted(set(cuts)) and len(cuts) <= 3
        path = scratch_path(spark, "cuts")
        B.store_cuts(spark, cuts, kind, path)
        assert B.stored_cuts(spark, path) == cuts
        got = df.select("k", B.partition_number("k", cuts).alias("p")).collect()
        assert all(r.p == (sum(c < r.k for c in cuts) if r.k is not None else 0) for r in got)


def test_two_tables_one_partition_file(spark):
    rng = random.Random(3)
    a = [(rng.randint(0, 5000), i) for i in range(4000)] + [(None, -1)]
    b = [(rng.randint(-50, 6000), i) for i in range(1000)]
    da, db = (spark.createDataFrame(x, "k long, v long").repartition(3) for x in (a, b))
    cuts = B.range_cuts(da, "k", 5)
    ta, tb = (B.write_dealt(d, "k", cuts, scratch_path(spark, "d")) for d in (da, db))
    merged = B.merge_sorted([ta, tb], "k", cuts)
    check = O.order_check(merged, ["k"]).first()
    assert (check["rows"], check.inversions) == (5001, 0)
    j = B.merge_join(ta, tb.withColumnRenamed("v", "w"), "k", cuts)
    want = sorted((k, v, w) for k, v in a for x, w in b if k == x)
    assert sorted((r.k, r.v, r.w) for r in j.collect()) == want
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_large_ranges_are_the_work_of_several_tasks(spark, monkeypatch):
    """A range of a partition file is cut into pieces: no task sorts or joins a whole one."""
    a = [(i * 7 % 5000, i) for i in range(6000)] + [(None, -1)]
    b = [(k, -k) for k in range(0, 9000, 2)]
    da, db = (spark.createDataFrame(x, "k long, v long").repartition(3) for x in (a, b))
    cuts = B.range_cuts(da, "k", 2)
    ta, tb = (B.write_dealt(d, "k", cuts, scratch_path(spark, "d")) for d in (da, db))
    want = sorted((k, v, -k) for k, v in a if k is not None and k % 2 == 0)
    for rows in (500, 1 << 21):
        monkeypatch.setattr(B, "PIECE_ROWS", rows)
        j = B.merge_join(ta, tb.withColumnRenamed("v", "w"), "k", cuts)
        assert sorted((r.k, r.v, r.w) for r in j.collect()) == want
        most = j.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 500 if rows == 500 else most > 1000
    assert len(B.finer([ta, tb], "k", cuts)) == len(cuts)
    dealt = B.deal(da, "k", cuts)
    assert "rangepartitioning" in dealt._jdf.queryExecution().executedPlan().toString()
    check = O.order_check(B.merge_sorted([ta, tb], "k", cuts), ["k"]).first()
    assert (check["rows"], check.inversions) == (6001 + 4500, 0)
