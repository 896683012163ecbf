"""Scalar functions, SQL functions, user aggregates, script transforms."""
from pyspark.sql import functions as F

from sparkwright.functions import scalar as X
from sparkwright.functions import transform as TR
from sparkwright.functions.udfs import MAXIMUM, MEAN, invoke, register_sql_functions


def test_strip_and_trim(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT strip('  bee  ') a, STRIP('banana', 'ab') b").first()
    assert (r.a, r.b) == ("bee", "nan")
    df = spark.createDataFrame([(" pomegranate",), ("banana  ",), ("apple",), ("  lychee ",)], "f string")
    assert [r.t for r in df.select(X.java_trim("f").alias("t")).collect()] == [
        "pomegranate", "banana", "apple", "lychee"]


def test_text_measures(spark):
    df = spark.createDataFrame([("Aß東\U00010400",)], "s string")
    r = df.select(X.char_length("s").alias("n"), X.byte_length("s").alias("b"),
                  X.byte_offsets("s").alias("o"), X.code_points("s").alias("cp"),
                  X.find_byte("s", "東").alias("f")).first()
    assert (r.n, r.b, r.o, r.f) == (4, 10, [0, 1, 3, 6], 3)
    assert r.cp == [0x41, 0xDF, 0x6771, 0x10400]


def test_is_good_quality(spark):
    df = spark.createDataFrame([(0,), (2,), (None,), (9,)], "q int")
    assert [r.g for r in df.select(X.is_good_quality("q").alias("g")).collect()] == [
        True, False, False, True]
    register_sql_functions(spark)
    assert spark.sql("SELECT isgood(NULL) a, isgood(4) b").first() == (False, True)


def test_user_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "k string, v int")
    r = {x.k: (x.m, x.avg) for x in df.groupBy("k").agg(
        MAXIMUM("v").alias("m"), MEAN("v").alias("avg")).collect()}
    assert r == {"a": (3, 2.0), "b": (None, None)}


def test_invoke_by_name(spark):
    assert spark.range(1).select(invoke("upper", F.lit("abc")).alias("u")).first().u == "ABC"


def test_reverse_key_orders_newest_first(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "s string")
    r = df.select(X.reverse_time_key(F.to_timestamp("s")).alias("k")).collect()
    assert r[1].k < r[0].k


def test_stream_through_command(spark):
    a = spark.createDataFrame([("Joe", "cherry", 2), ("Ali", "apple", 3), ("Joe", "banana", 2),
                               ("Eve", "apple", 7)], "f0 string, f1 string, f2 int")
    out = TR.transform(a, ["f0", "f1", "f2"], "cut -f 2", "fruit STRING")
    assert sorted(r.fruit for r in out.collect()) == ["apple", "apple", "banana", "cherry"]


def test_map_combine_reduce_scripts(spark):
    rows = [("1950", 0.0, 1), ("1950", 22.0, 1), ("1950", -11.0, 1), ("1949", 111.0, 1),
            ("1949", 78.0, 1), ("1949", 500.0, 2)]
    df = spark.createDataFrame(rows, "year string, temperature double, quality int").repartition(3)
    out = TR.map_combine_reduce(df, "year", "temperature", "quality",
                                TR.script_command(spark, "max_temp_map.py"),
                                TR.script_command(spark, "max_temp_reduce.py"), "max_t")
    assert sorted((r.year, r.max_t) for r in out.collect()) == [("1949", 111.0), ("1950", 22.0)]


def test_strip_takes_tabs_and_newlines(spark):
    from sparkwright.functions import scalar as X
    from sparkwright.functions.udfs import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([("\t a b \n",)], "s string")
    assert df.select(X.strip("s"), F.expr("STRIP(s)"), F.expr("strip(s, '\t')")).first()[:2] == ("a b", "a b")
