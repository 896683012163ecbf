"""Operators on the literal fixtures (goldens from the fixture tables).

# The small rows and results below are those of the fixture tables.
"""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.operators import aggregates as A
from sparkwright.operators import bags as B
from sparkwright.operators import joins as J
from sparkwright.operators import ordering as O
from sparkwright.operators import projection as P
from sparkwright.operators import sets as U
from sparkwright.plans.pagerank import pagerank


@pytest.fixture()
def sales(spark):
    return spark.createDataFrame([("Joe", 2), ("Hank", 4), ("Ali", 0), ("Eve", 3), ("Hank", 2)],
                                 "name string, id int")


@pytest.fixture()
def things(spark):
    return spark.createDataFrame([(2, "Tie"), (4, "Coat"), (3, "Hat"), (1, "Scarf")],
                                 "id int, thing string")


def test_project_positional(spark):
    a = spark.createDataFrame([("Joe", "cherry", 2), ("Ali", "apple", 3), ("Joe", "banana", 2),
                               ("Eve", "apple", 7)], "f0 string, f1 string, f2 int")
    r = a.select(P.positional(a, 0), P.positional(a, 2) + 1, F.lit("Constant")).collect()
    assert [tuple(x) for x in r] == [("Joe", 3, "Constant"), ("Ali", 4, "Constant"),
                                     ("Joe", 3, "Constant"), ("Eve", 8, "Constant")]


def test_split_with_null(spark):
    df = spark.createDataFrame([("1950", 0), ("1950", 22), ("1950", None), ("1949", 111), ("1949", 78)],
                               "year string, temperature int")
    good, bad = P.split_relation(df, F.col("temperature").isNotNull())
    assert good.count() == 4 and [tuple(x) for x in bad.collect()] == [("1950", None)]


def test_group_by_expression(spark):
    a = spark.createDataFrame([("Joe", "cherry"), ("Ali", "apple"), ("Joe", "banana"), ("Eve", "apple")],
                              "name string, fruit string")
    g = B.group_to_bag(a.withColumn("k", F.length("fruit")), "k", ["name", "fruit"])
    out = {r.k: [tuple(x) for x in r.bag] for r in g.collect()}
    assert out == {5: [("Ali", "apple"), ("Eve", "apple")], 6: [("Joe", "banana"), ("Joe", "cherry")]}


def test_joins(sales, things):
    inner = J.join(things, sales, "id").select("id", "thing", "name").collect()
    assert sorted(tuple(r) for r in inner) == [(2, "Tie", "Hank"), (2, "Tie", "Joe"),
                                               (3, "Hat", "Eve"), (4, "Coat", "Hank")]
    left = J.join(things, sales, "id", "left").where(F.col("name").isNull()).collect()
    assert [(r.id, r.thing) for r in left] == [(1, "Scarf")]
    right = J.join(things, sales, "id", "right").where(F.col("thing").isNull()).collect()
    assert [(r.id, r.name) for r in right] == [(0, "Ali")]
    assert J.join(things, sales, "id", "full").count() == 6
    assert sorted(r.id for r in J.join(things, sales, "id", "left_semi").collect()) == [2, 3, 4]


def test_cogroup(sales, things):
    g = B.cogroup(things, "id", ["thing"], sales, "id", ["name"], key="id")
    out = {r.id: ([x.thing for x in r.a], [x.name for x in r.b]) for r in g.collect()}
    assert out == {0: ([], ["Ali"]), 1: (["Scarf"], []), 2: (["Tie"], ["Hank", "Joe"]),
                   3: (["Hat"], ["Eve"]), 4: (["Coat"], ["Hank"])}
    inner = B.cogroup(things, "id", ["thing"], sales, "id", ["name"], key="id", inner_a=True)
    assert sorted(r.id for r in inner.collect()) == [1, 2, 3, 4]
    rendered = g.select("id", B.render_bag("b", ["name"]).alias("s")).where("id = 2").first()
    assert rendered.s == "{(Hank),(Joe)}"


def test_lookup_fallback(spark):
    recs = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "sid string, t int")
    names = spark.createDataFrame([("a", "Alpha"), ("b", "  ")], "sid string, name string")
    r = J.lookup_with_fallback(recs, "sid", names, "sid", "name").orderBy("sid").collect()
    assert [x.name for x in r] == ["Alpha", "b", "c"]


def test_sort_and_limit(spark):
    a = spark.createDataFrame([(2, 3), (1, 2), (2, 4)], "a int, b int")
    r = O.order_by(a, ["a", "b"], [True, False]).collect()
    assert [tuple(x) for x in r] == [(1, 2), (2, 4), (2, 3)]
    assert [tuple(x) for x in O.top_k(a, 2, ["a", "b"], [True, False]).collect()] == [(1, 2), (2, 4)]


def test_pair_sorts(spark):
    df = spark.createDataFrame([(1950, 0), (1950, 22), (1950, -11), (1949, 111), (1949, 78)], "y int, t int")
    asc = [tuple(r) for r in O.order_by(df, ["y", "t"]).collect()]
    assert asc == [(1949, 78), (1949, 111), (1950, -11), (1950, 0), (1950, 22)]
    mixed = [tuple(r) for r in O.order_by(df, ["y", "t"], [True, False]).collect()]
    assert mixed == [(1949, 111), (1949, 78), (1950, 22), (1950, 0), (1950, -11)]


def test_field_spec_sort(spark):
    df = spark.createDataFrame([("2\t30",), ("10\t4",), ("10\t30",)], "line string")
    assert [r.line for r in O.field_spec_sort(df, "line", "-k1").collect()][0] == "10\t30"
    assert [r.line for r in O.field_spec_sort(df, "line", "-k1n").collect()][0] == "2\t30"
    assert [r.line for r in O.field_spec_sort(df, "line", "-k1n -k2nr").collect()] == [
        "2\t30", "10\t30", "10\t4"]
    with pytest.raises(ValueError):
        O.parse_key_spec("-q1")


def test_schema_sort(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", "x")], "left string, right string")
    r = O.schema_sort(df, {"left": O.DESCENDING, "right": O.IGNORE}).collect()
    assert [x.left for x in r] == ["b", "a", "a"]


def test_partition_of_matches_repartition(spark):
    df = spark.range(200).withColumn("k", F.col("id") % 17)
    r = df.repartition(5, "k").select("k", F.spark_partition_id().alias("p"),
                                      O.partition_of("k", 5).alias("q"))
    assert r.where("p != q").count() == 0


def test_total_sort_balance(spark):
    df = spark.range(0, 20000).select((F.col("id") % 1000).alias("t"), "id")
    sizes = [r.n for r in O.partition_sizes(O.total_sort(df, ["t"], partitions=4)).collect()]
    assert max(sizes) / (sum(sizes) / len(sizes)) <= 1.2


def test_union_widths(spark):
    a = spark.createDataFrame([(2, 3), (1, 2), (2, 4)], "x int, y int")
    b = spark.createDataFrame([("z", "x", 8), ("w", "y", 1)], "p string, q string, r int")
    u = U.union_positional([a, b]).collect()
    assert len(u) == 5 and u[0].f2 is None and u[3].f2 == "8"


def test_bucket_sample(spark):
    users = spark.createDataFrame([(0, "Nat"), (2, "Joe"), (3, "Kay"), (4, "Ann")], "id int, name string")
    assert sorted(r.id for r in U.bucket_sample(users, "id", 1, 4).collect()) == [0, 4]
    assert sorted(r.id for r in U.bucket_sample(users, "id", 1, 2).collect()) == [0, 2, 4]


def test_collections(spark):
    fruit = spark.createDataFrame([("cherry",), ("apple",), ("banana",)], "v string")
    c = B.concat_values(fruit.withColumn("k", F.length("v")), "k", "v", ";").orderBy("k").collect()
    assert [(r.k, r["values"]) for r in c] == [(5, "apple"), (6, "banana;cherry")]
    words = spark.createDataFrame([("cherry",), ("apple",), ("banana",), ("banana",)], "v string")
    s = words.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    assert tuple(s) == (4, "apple", "cherry")
    top = O.top_k(B.count_values(words, "v"), 1, ["n"], [False]).first()
    assert (top.v, top.n) == ("banana", 2)
    pairs = spark.createDataFrame([("a", 3), ("a", 1), ("b", 7), ("a", 5)], "k string, v int")
    sums = {r.k: r.s for r in pairs.groupBy("k").agg(F.sum("v").alias("s")).collect()}
    assert sums == {"a": 9, "b": 7}
    uniq = {r.k: r["values"] for r in B.unique_values(pairs, "k", "v").collect()}
    assert uniq == {"a": [1, 3, 5], "b": [7]}


def test_count_histogram(spark):
    words = spark.createDataFrame([("b c a e b",)], "text string")
    h = {r.occurrences: r.words for r in A.count_histogram(words).collect()}
    assert h == {1: 3, 2: 1}


def test_flatten_empty_bag_drops_row(spark):
    df = spark.createDataFrame([(1, [(1, "a")]), (2, [])], "k int, bag array<struct<x:int,y:string>>")
    assert [tuple(r) for r in B.flatten_bag(df, "bag").collect()] == [(1, 1, "a")]


def test_reader_schema(spark, tmp_path):
    path = str(tmp_path / "pairs")
    spark.createDataFrame([("L", "R")], "left string, right string").write.parquet(path)
    wider = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType()),
                          T.StructField("description", T.StringType())])
    r = P.read_parquet_as(spark, path, wider, defaults={"description": ""}).first()
    assert r.description == ""
    assert P.read_parquet_as(spark, path, wider).first().description is None
    renamed = T.StructType([T.StructField("first", T.StringType()),
                            T.StructField("second", T.StringType())])
    r = P.read_parquet_as(spark, path, renamed, aliases={"first": ["left"], "second": ["right"]})
    assert r.columns == ["first", "second"] and tuple(r.first()) == ("L", "R")
    bad = T.StructType([T.StructField("left", T.IntegerType())])
    with pytest.raises(P.SchemaMismatch):
        P.read_parquet_as(spark, path, bad)


def test_pagerank_golden(spark):
    links = {"A": "BCDE", "B": "DE", "C": "D", "D": "B", "E": "A", "F": "BC"}
    edges = spark.createDataFrame([(f"www.{s}.com", f"www.{d}.com") for s, ds in links.items()
                                   for d in ds], "src string, dst string")
    pages, rounds, delta = pagerank(edges, d=0.5, tol=0.01)
    assert abs(delta - 0.0048) <= 0.001 and rounds == 5
    scores = {r.page[4]: round(r.score, 4) for r in pages.collect()}
    assert scores == {"A": 0.9922, "B": 1.4263, "C": 0.7485, "D": 1.3535, "E": 0.9795, "F": 0.5}


def test_checked_broadcast(spark):
    small, big = spark.range(5), spark.range(100)
    plan = big.join(J.checked_broadcast(small), "id")._jdf.queryExecution().toString()
    assert "Broadcast" in plan
    assert J.estimated_bytes(small) == 40
    plan = big.join(J.checked_broadcast(small, 39), "id")._jdf.queryExecution().analyzed().toString()
    assert "UnresolvedHint" not in plan and "ResolvedHint" not in plan


def test_merge_keeps_fractions(spark):
    a = spark.createDataFrame([("k", 1.7, 2)], "key string, x double, n int")
    b = spark.createDataFrame([("k", 0.7, 3), ("m", 0.5, 1)], "key string, x double, n int")
    got = {r.key: (r.n, round(r.x, 6)) for r in J.merge_by_key([a, b], "key").collect()}
    assert got == {"k": (5, 2.4), "m": (1, 0.5)}
    mixed = J.merge_by_key([a.drop("n"), b.select("key", F.col("n").alias("x"))], "key")
    assert dict(mixed.dtypes)["x"] == "double"


def test_cogroup_null_keys_of_both_sides_stay_apart(spark):
    a = spark.createDataFrame([(None, "p"), (1, "q")], "k int, v string")
    b = spark.createDataFrame([(None, "r"), (1, "s")], "k int, w string")
    outer = B.cogroup(a, "k", ["v"], b, "k", ["w"]).collect()
    assert sorted(([x.v for x in r.a], [x.w for x in r.b]) for r in outer) == [([], ["r"]), (["p"], []), (["q"], ["s"])]
    inner = B.cogroup(a, "k", ["v"], b, "k", ["w"], inner_a=True, inner_b=True).collect()
    assert [r.key for r in inner] == [1]


def test_stored_null_is_not_replaced_by_the_default(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.createDataFrame([("L", None), ("M", "R")], "left string, right string").write.parquet(path)
    reader = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
    got = P.read_parquet_as(spark, path, reader, defaults={"right": "d"}).orderBy("left").collect()
    assert [r.right for r in got] == [None, "R"]


def test_order_check_sees_disorder(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("b"))
    for cols, up in ((["a"], [True]), (["a", "b"], [True, False]), (["b"], [False])):
        good = O.order_check(O.order_by(df, cols, up), cols, up).first()
        assert tuple(good) == (5000, 0)
        assert O.order_check(df, cols, up).first().inversions > 100
    local = df.repartition(3, "a").sortWithinPartitions("a")
    assert O.order_check(local, ["a"], across=False).first().inversions == 0
    assert O.order_check(local, ["a"]).first().inversions > 0


def test_equal_rows_are_cut_between_partitions(spark):
    lines = spark.range(0, 20000, numPartitions=4).select(F.when(F.col("id") % 2 == 0, "1\tx").otherwise("2\tx").alias("line"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r.n for r in O.partition_sizes(O.field_spec_sort(lines, "line", "-k1n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 7000


def test_pagerank_needs_an_end(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    with pytest.raises(ValueError):
        pagerank(edges, tol=0.0)
    assert pagerank(edges, rounds=3)[1] == 3
