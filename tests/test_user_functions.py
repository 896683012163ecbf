"""User aggregates with a state, and row functions with a set-up: against plain Python."""

import datetime
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkwright.functions import row_function as R
from sparkwright.functions import state_aggregate as S


def readings(spark, parts=5):
    rng = random.Random(4)
    start = datetime.date(1969, 11, 20)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 2), rng.choice([None, 0.1, -3.5, 1e300, -1e300, 2.0 ** -1060, 7.0]),
             start + datetime.timedelta(days=rng.randint(0, 120)) if rng.random() < 0.9 else None) for _ in range(700)]
    rows += [("only nulls", 1, None, None)]
    return rows, spark.createDataFrame(rows, "k string, j int, v double, day date").repartition(parts)


def groups(rows, value):
    out = defaultdict(list)
    for r in rows:
        out[r[0], r[1]].append(r[value])
    return out


def test_mean_is_exact(spark):
    rows, df = readings(spark)
    got = {(r.k, r.j): r.m for r in S.aggregate_states(df, ["k", "j"], "v", S.Mean(), "m").collect()}
    want = {key: float(sum(map(Fraction, x)) / len(x)) if (x := [v for v in values if v is not None]) else None
            for key, values in groups(rows, 2).items()}
    assert got == want


def test_longest_run(spark):
    rows, df = readings(spark)
    got = {(r.k, r.j): r.n for r in S.aggregate_states(df, ["k", "j"], "day", S.LongestRun(), "n").collect()}
    for key, values in groups(rows, 3).items():
        days, best = {d for d in values if d}, 0
        for d in days:
            n = 1
            while d + datetime.timedelta(days=n) in days:
                n += 1
            best = max(best, n)
        assert got.pop(key) == best
    assert not got


def test_one_state_a_key_and_task(spark):
    rows, df = readings(spark, parts=6)
    states = S.task_states(df, ["k", "j"], "v", S.Mean())
    per = states.groupBy("k", "j", "_task").count().collect()
    assert all(r["count"] == 1 for r in per) and len({r._task for r in per}) == 6
    assert len(per) <= 6 * len(groups(rows, 2))


def test_states_in_rounds(spark, monkeypatch):
    """More keys than a task may hold: several states a key, the same result."""
    monkeypatch.setattr(S, "FAN_IN", 2)
    rows, df = readings(spark, parts=7)
    whole = {(r.k, r.j): r.m for r in S.aggregate_states(df, ["k", "j"], "v", S.Mean(), "m").collect()}
    one = {tuple(r): 1 for r in S.aggregate_states(df.coalesce(1), ["k", "j"], "v", S.Mean(), "m").collect()}
    assert {(*k, v): 1 for k, v in whole.items()} == one


def test_odd_input(spark):
    df = spark.createDataFrame([(1, math.nan), (1, 2.0), (2, math.inf), (3, None)], "k int, v double")
    got = {r.k: r.m for r in S.aggregate_states(df, ["k"], "v", S.Mean(), "m").collect()}
    assert math.isnan(got[1]) and got[2] == math.inf and got[3] is None
    assert S.aggregate_states(df.where("k > 5"), ["k"], "v", S.Mean(), "m").collect() == []
    assert S.aggregate_states(df.where("k = 1"), [], "k", S.Maximum(), "m").collect()[0].m == 1


def test_maximum_merges_like_the_built_in(spark):
    _, df = readings(spark)
    got = S.aggregate_states(df, ["k"], "j", S.Maximum(), "m")
    assert sorted(map(str, got.collect())) == sorted(map(str, df.groupBy("k").agg(F.max("j").cast("long").alias("m")).collect()))


def test_one_set_up_a_task(spark):
    class Doubler(R.RowFunction):
        """Needs a helper that cannot travel; emits a row n times, and the rows it saw at the end."""

        def initialize(self):
            self.helper, self.seen = (x for x in ()), 0

        def process(self, row, emit):
            assert self.helper is not None
            self.seen += 1
            for _ in range(row["n"]):
                emit(row["id"], 2 * row["id"])

        def cleanup(self, emit):
            emit(None, self.seen)

    df = spark.range(0, 100, numPartitions=4).selectExpr("id", "cast(id % 3 as int) n")
    setups = spark.sparkContext.accumulator(0)
    got = R.parallel_do(df, Doubler(), "id long, x long", setups).collect()
    assert setups.value == 4
    assert Counter((r.id, r.x) for r in got if r.id is not None) == Counter((i, 2 * i) for i in range(100) for _ in range(i % 3))
    assert [r.x for r in got if r.id is None] == [25] * 4


def test_emitter_checks_its_width(spark):
    class Wrong(R.RowFunction):
        def process(self, row, emit):
            emit(1)
    with pytest.raises(Exception, match="1 values for 2 columns"):
        R.parallel_do(spark.range(1), Wrong(), "a long, b long").collect()


def test_phrases_against_plain_search(spark):
    rng = random.Random(1)
    phrases = ["ab", "abc", "b", "ca b", "é"]
    docs = [(i, "".join(rng.choices("abc é", k=rng.randint(0, 60)))) for i in range(80)] + [(80, None), (81, "")]
    want = sorted((i, p, n) for i, t in docs for p in phrases
                  if (n := sum((t or "").startswith(p, k) for k in range(len(t or "")))))
    d = spark.createDataFrame(docs, "id long, t string").repartition(3)
    p = spark.createDataFrame([(x,) for x in [*phrases, "ab", "", None]], "p string")
    for max_bytes in (8 << 20, 3):
        assert sorted(map(tuple, R.count_phrases(d, "id", "t", p, "p", max_bytes).collect())) == want
    assert R.count_phrases(d, "id", "t", p.where("false"), "p").collect() == []


def test_keys_of_a_batch():
    batch = pa.RecordBatch.from_pydict({"a": ["x", None, "x", "y"], "b": [1, 1, 2, 1]})
    got = {key: places.to_pylist() for key, places in S._split(batch, ["a", "b"])}
    assert got == {("x", 1): [0], (None, 1): [1], ("x", 2): [2], ("y", 1): [3]}
    assert {k: p.to_pylist() for k, p in S._split(batch, [])} == {(): [0, 1, 2, 3]}
