"""Chunked bags, blocked ranking, distinct bitmaps, nested schemas, compaction by size, committed streams."""

import datetime
import random
import re
from collections import defaultdict

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.operators import chunked_bags as C
from sparkwright.operators import distinct_sets as D
from sparkwright.operators import schema_resolution as N
from sparkwright.operators.projection import SchemaMismatch
from sparkwright.plans import pagerank as G
from sparkwright.session import cleanup, scratch_path
from sparkwright.sinks import compaction as K
from sparkwright.streaming import committed as M

# --- chunked bags ---------------------------------------------------------------


def rows(seed=1, n=2000):
    """One key with a third of the rows, equal rows, null keys and null values."""
    rng = random.Random(seed)
    return [("hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c"]), rng.choice([None, 1, 2, 3, 4]), rng.choice("xyz")) for i in range(n)]


def bags(data):
    out = defaultdict(list)
    for k, n, s in data:
        out[k].append((n, s))
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for k, v in out.items()}


@pytest.mark.parametrize("bound", [1, 7, 100, 10_000])
def test_chunks_in_order(spark, bound):
    data = rows(n=300 if bound == 1 else 2000)
    df = spark.createDataFrame(data, "k string, n int, s string").repartition(5)
    got = defaultdict(dict)
    for r in C.group_to_chunks(df, "k", ["n", "s"], bound).collect():
        assert len(r.bag) <= bound and r.chunk not in got[r.k]
        got[r.k][r.chunk] = [tuple(x) for x in r.bag]
    want = bags(data)
    assert set(got) == set(want)
    for k, chunks in got.items():
        assert sorted(chunks) == list(range(len(chunks))) and all(len(chunks[c]) == bound for c in range(len(chunks) - 1))
        assert [r for c in sorted(chunks) for r in chunks[c]] == want[k]


def test_hot_key_ends_in_many_tasks(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # the table is small here
    try:
        spread = C.numbered_rows(df.repartition(8), "k", ["id"]).where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) >= 2 and max(r["count"] for r in spread) < 13_334 * 0.8
    chunks = C.group_to_chunks(df, "k", ["id"], 500).where("k = 0")
    assert chunks.count() == -(-13_334 // 500)


def test_flatten_is_the_inverse(spark):
    df = spark.createDataFrame(rows(), "k string, n int, s string")
    flat = C.flatten_chunks(C.group_to_chunks(df, ["k"], ["n", "s"], 50), "bag")
    assert sorted(map(str, flat.collect())) == sorted(map(str, df.collect()))
    values = C.collect_chunks(df, "k", "n", 30)
    assert values.agg(F.sum(F.size("values"))).first()[0] == df.where("n is not null").count()
    assert C.group_to_chunks(df.where("false"), "k", ["n"]).collect() == []


@pytest.mark.parametrize("inner_a, inner_b", [(False, False), (True, False), (False, True), (True, True)])
def test_cogroup_chunks(spark, inner_a, inner_b):
    rng = random.Random(3)
    a = [(rng.choice([1, 2, 3, None]), i) for i in range(60)]
    b = [(rng.choice([2, 3, 4, None]), i) for i in range(25)]
    got = defaultdict(lambda: ([], []))
    g = C.cogroup_chunks(spark.createDataFrame(a, "x int, v int"), "x", ["v"], spark.createDataFrame(b, "y int, w int"), "y", ["w"],
                         inner_a=inner_a, inner_b=inner_b, bound=7)
    for r in sorted(g.collect(), key=lambda r: r.chunk):
        assert len(r.a) <= 7 and len(r.b) <= 7 and (r.a or r.b)
        key = r.key if r.key is not None else ("null", bool(r.a))
        got[key][0].extend(x.v for x in r.a)
        got[key][1].extend(x.w for x in r.b)
    want = {}
    for key in (1, 2, 3, 4, ("null", True), ("null", False)):
        va = sorted(v for k, v in a if k == key or (k is None and key == ("null", True)))
        vb = sorted(w for k, w in b if k == key or (k is None and key == ("null", False)))
        if (va or not inner_a) and (vb or not inner_b):
            want[key] = (va, vb)
    assert dict(got) == want


def test_flatten_one(spark):
    a = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r"), (3, "s")], "x int, v string")
    b = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 9), (7, 9)], "y int, w int")
    got = sorted((r.key, r.v, r.chunk, [x.w for x in r.b]) for r in C.flatten_one(a, "x", ["v"], b, "y", ["w"], bound=3).collect())
    assert got == [(1, "p", 0, [0, 1, 2]), (1, "p", 1, [3, 4]), (1, "q", 0, [0, 1, 2]), (1, "q", 1, [3, 4]), (2, "r", 0, [9])]


# --- blocked ranking ------------------------------------------------------------

def test_blocked_ranking_against_plain_loops(spark):
    rng = random.Random(5)
    edges = [(0, i) for i in range(90)] + [(rng.randint(0, 40), rng.randint(0, 99)) for _ in range(300)] + [(1, 2), (1, 2)]
    pages, _, _ = G.pagerank(spark.createDataFrame(edges, "src long, dst long").repartition(4), d=0.3, rounds=4, block=8, slot_blocks=2, buckets=4)
    out = defaultdict(set)
    for s, t in edges:
        out[s].add(t)
    score = {p: 1.0 for p in out}
    for _ in range(4):
        inflow = defaultdict(float)
        for s, targets in out.items():
            for t in targets:
                inflow[t] += score[s] / len(targets)
        score = {p: 0.3 + 0.7 * inflow[p] for p in out}
    got = {r.page: r.score for r in pages.collect()}
    assert set(got) == set(score) and all(abs(got[p] - score[p]) < 1e-9 for p in score)


def test_edges_are_not_shuffled_in_a_round(spark):
    edges = spark.range(3000).select((F.col("id") % 7).alias("src"), F.col("id").alias("dst"))
    blocks, pages = G.link_table(edges, block=16, slot_blocks=4, buckets=4)
    sizes = blocks.agg(F.max(F.size("targets")), F.count_distinct("src", "slot")).first()
    assert sizes[0] < 3 * 16 and sizes[1] > 2 * 7          # a page lies in several slots
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = G.rank_round(blocks, pages.checkpoint(), 0.5)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = next(i for i, line in enumerate(plan) if "Scan parquet" in line and "targets" in line)
    depth = len(plan[scan]) - len(plan[scan].lstrip(" :+-"))
    above = []
    for line in reversed(plan[:scan]):          # the operators between the blocks' scan and their join
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            above.append(line.strip(" :+-"))
            depth = d
        if "Join" in line and d <= depth:
            break
    assert "Join" in above[-1] and not any("Exchange" in x for x in above) and "Bucketed: true" in plan[scan]


def test_cleanup_drops_the_tables(spark):
    G.link_table(spark.createDataFrame([(1, 2)], "src long, dst long"))
    assert [t for t in spark.catalog.listTables() if t.name.startswith("links_")]
    cleanup(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("links_")]


# --- distinct sets ----------------------------------------------------------------

def test_bitmaps_count_any_period(spark):
    rng = random.Random(7)
    log = [(rng.choice(["t1", "t2", None]), datetime.date(2024, 1, rng.randint(1, 20)),
            rng.choice([None, 0, 1, -1, 32767, 32768, 32769, -32768, 10 ** 12, rng.randint(0, 99)])) for _ in range(900)]
    df = spark.createDataFrame(log, "track string, day date, user long").repartition(4)
    sets = D.daily_sets(df, ["track"], F.col("day"), "user")
    for first, last in ((None, None), (5, 5), (3, 11), (21, 30)):
        days = tuple(datetime.date(2024, 1, d) if d else None for d in (first, last))
        want = defaultdict(set)
        for t, d, u in log:
            if u is not None and (days[0] is None or days[0] <= d) and (days[1] is None or d <= days[1]):
                want[t].add(u)
        got = {r.track: r.n for r in D.distinct_counts(sets, ["track"], *days).collect()}
        assert got == {t: len(u) for t, u in want.items()}
        total = D.distinct_counts(sets, [], *days).collect()
        assert sum(r.n or 0 for r in total) == len(set().union(*want.values()))
    early, late = (None, datetime.date(2024, 1, 9)), (datetime.date(2024, 1, 10), None)
    want = {t: len({u for x, d, u in log if x == t and u is not None and d <= early[1]} &
                   {u for x, d, u in log if x == t and u is not None and d >= late[0]}) for t in ("t1", "t2", None)}
    assert {r.track: r.n for r in D.returning_counts(sets, ["track"], early, late).collect()} == want
    half = D.daily_sets(df.limit(500), ["track"], F.col("day"), "user")
    again = D.add_days(sets, half, ["track"])
    assert sorted(map(str, D.distinct_counts(again, ["track"]).collect())) == sorted(map(str, D.distinct_counts(sets, ["track"]).collect()))


# --- nested schemas ------------------------------------------------------------------

S, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
NESTED = "id int, p struct<n: int, q: struct<a: string, b: array<struct<x: int, y: string>>>>, m map<string, struct<v: float>>"


def nested(spark):
    return spark.createDataFrame([
        (1, (5, ("a", [(1, "one"), None, (2, None)])), {"k": (1.5,), "z": None}), (2, (None, (None, None)), None), (3, None, {})], NESTED)


def test_nested_resolution(spark):
    reader = T.StructType([
        N.reader_field("key", LONG, former=["no", "id"]),
        N.reader_field("p", T.StructType([
            N.reader_field("added", T.ArrayType(INT), default=[7]),
            N.reader_field("deep", T.StructType([N.reader_field("items", T.ArrayType(T.StructType([
                N.reader_field("x", DOUBLE), N.reader_field("text", T.BinaryType(), former=["y"]), N.reader_field("new", S)])), former=["b"])]), former=["q"])])),
        N.reader_field("m", T.MapType(S, T.StructType([N.reader_field("v", DOUBLE), N.reader_field("w", INT, False, default=3)]))),
        N.reader_field("rest", T.StructType([N.reader_field("r", S)]), default={"r": "d"})])
    got = {r.key: r.asDict(True) for r in N.read_as(nested(spark), reader).collect()}
    assert got[1] == {"key": 1, "p": {"added": [7], "deep": {"items": [
        {"x": 1.0, "text": bytearray(b"one"), "new": None}, None, {"x": 2.0, "text": None, "new": None}]}},
        "m": {"k": {"v": 1.5, "w": 3}, "z": None}, "rest": {"r": "d"}}
    assert got[2] == {"key": 2, "p": {"added": [7], "deep": {"items": None}}, "m": None, "rest": {"r": "d"}}
    assert got[3] == {"key": 3, "p": None, "m": {}, "rest": {"r": "d"}}


def test_errors_name_their_paths(spark):
    reader = T.StructType([
        N.reader_field("id", S),
        N.reader_field("p", T.StructType([N.reader_field("n", T.ShortType()), N.reader_field("q", T.StructType([
            N.reader_field("b", T.ArrayType(T.StructType([N.reader_field("x", T.BooleanType()), N.reader_field("z", INT, False)])))]))])),
        N.reader_field("m", T.MapType(INT, T.StructType([N.reader_field("v", LONG)])))])
    with pytest.raises(SchemaMismatch) as e:
        N.read_as(nested(spark), reader)
    paths = [x.split(":")[0] for x in str(e.value).split("; ")]
    assert paths == ["id", "p.n", "p.q.b[].x", "p.q.b[].z", "m", "m{}.v"]


def test_only_needed_fields_are_read(spark):
    path = scratch_path(spark, "nested")
    nested(spark).write.parquet(path)
    reader = T.StructType([N.reader_field("p", T.StructType([N.reader_field("number", LONG, former=["n"])]))])
    df = N.read_as(spark.read.parquet(path), reader)
    schema = re.search(r"ReadSchema: (\S+)", df._jdf.queryExecution().executedPlan().toString()).group(1)
    assert schema == "struct<p:struct<n:int>>" and [r.p.number if r.p else r.p for r in df.orderBy("p.number").collect()].count(5) == 1


@pytest.mark.parametrize("a, b, good", [("decimal(5,2)", "decimal(8,3)", True), ("decimal(5,2)", "decimal(5,3)", False), ("int", "float", True),
                                        ("double", "float", False), ("bigint", "int", False), ("string", "binary", True), ("tinyint", "bigint", True)])
def test_widening(spark, a, b, good):
    df = spark.sql(f"SELECT array(cast(1 as {a})) x")
    reader = T.StructType([T.StructField("x", T.ArrayType(T._parse_datatype_string(b)))])
    if good:
        assert N.read_as(df, reader).schema["x"].dataType.elementType == T._parse_datatype_string(b)
    else:
        with pytest.raises(SchemaMismatch, match=r"x\[\]"):
            N.read_as(df, reader)


# --- compaction by size -----------------------------------------------------------------

def test_outputs_hold_at_most_the_target(spark):
    rng = random.Random(2)
    sizes = [0, 1, 5000, 1000, 1001, 500, 501, 333, 200, 199] + [rng.randint(0, 260) for _ in range(3000)] + [rng.randint(150, 1200) for _ in range(300)]
    files = spark.createDataFrame([(f"f{i:05d}", n) for i, n in enumerate(sizes)], "path string, length long").repartition(3)
    got = K.plan(files, 1000).collect()
    assert sorted((r.path, r.length) for r in got) == [(f"f{i:05d}", n) for i, n in enumerate(sizes)]
    outputs = defaultdict(list)
    for r in got:
        outputs[r.output].append(r.length)
    assert sorted(outputs) == list(range(len(outputs)))
    assert all(sum(own) <= 1200 or len(own) == 1 for own in outputs.values())
    assert len(outputs) <= 2.2 * sum(sizes) / 1000
    assert K.plan(files.where("false"), 1000).collect() == []


@pytest.mark.parametrize("wave", [50_000, 4])
def test_contents_survive(spark, tmp_path, monkeypatch, wave):
    monkeypatch.setattr(K, "WAVE_FILES", wave)
    rng = random.Random(1)
    for i in range(30):
        (tmp_path / f"s {i}[x].bin").write_bytes(rng.randbytes(rng.choice([0, 10, 200, 3000])))
    out = scratch_path(spark, "packed")
    n = K.compact_by_size(spark, str(tmp_path), out, target=1000)
    got = {r.file.rsplit("/", 1)[1].replace("%20", " ").replace("%5B", "[").replace("%5D", "]"): bytes(r.content) for r in spark.read.parquet(out).collect()}
    assert got == {p.name: p.read_bytes() for p in tmp_path.iterdir() if p.stat().st_size}
    assert n == len(spark.read.parquet(out).inputFiles())


# --- committed streams ------------------------------------------------------------------

def test_readers_see_whole_batches(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"f{i}.txt").write_text(f"{i}a\n{i}b\n")
    out, checkpoint, seen, failed = scratch_path(spark, "out"), scratch_path(spark, "ckpt"), {}, []

    def look(number):
        # the batch's folder is there, and no reader sees it
        try:
            rows = M.read_committed(spark, out).collect()
        except FileNotFoundError:
            rows = []
        seen[number] = sorted({r.batch for r in rows})
        assert len(rows) % 2 == 0
        if number == 2 and not failed:
            failed.append(number)
            raise ConnectionError("lost")

    def run():
        lines = spark.readStream.format("text").option("maxFilesPerTrigger", 2).load(str(tmp_path))
        return M.run_committed(lines, out, checkpoint, look)

    with pytest.raises(StreamingQueryException):
        run()
    assert seen == {0: [], 1: [0], 2: [0, 1]}
    assert len(M.read_committed(spark, out).collect()) == 8
    assert run() == 3
    got = M.read_committed(spark, out).collect()
    assert sorted(r.value for r in got) == sorted(f"{i}{c}" for i in range(6) for c in "ab") and {r.batch for r in got} == {0, 1, 2}
    assert run() == 3 and len(M.read_committed(spark, out).collect()) == 12


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    """Lost between the manifest and the query's own checkpoint: the batch comes again and is skipped."""
    (tmp_path / "f.txt").write_text("x\n")
    out = scratch_path(spark, "out")
    for _ in range(2):      # a new checkpoint: batch 0 again
        assert M.run_committed(spark.readStream.format("text").load(str(tmp_path)), out) == 1
    assert [r.value for r in M.read_committed(spark, out).collect()] == ["x"]
