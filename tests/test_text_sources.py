"""Text readers against the literal fixtures."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.sources import text as S
from test_weather import NCDC

LINES = ["A first line of text", "caf\u00e9 \u00e0 la carte", "", "the fourth and last one"]


def test_cut_loader(spark, tmp_text):
    schema = T.StructType([T.StructField("year", T.IntegerType()),
                           T.StructField("temperature", T.IntegerType()),
                           T.StructField("quality", T.IntegerType())])
    r = S.load_cut(spark, tmp_text(NCDC), "16-19,88-92,93-93", schema).collect()
    assert [tuple(x) for x in r] == [(1950, 0, 1), (1950, 22, 1), (1950, -11, 1),
                                     (1949, 111, 1), (1949, 78, 1)]


def test_cut_range_past_end_is_null(spark, tmp_text):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    r = S.load_cut(spark, tmp_text(["abcdef"]), "1-2,5-9", schema).first()
    assert r.a == "ab" and r.b is None


def test_bad_range_spec():
    for bad in ["1-", "x", "5-3", "0-2"]:
        with pytest.raises(ValueError):
            S.parse_ranges(bad)
    assert S.parse_ranges("16-19,93") == [(16, 19), (93, 93)]


def test_byte_offsets(spark, tmp_text):
    r = S.lines_with_offsets(spark, tmp_text(LINES)).orderBy("offset").collect()
    assert [x.offset for x in r] == [0, 21, 39, 40]
    assert [x.line for x in r] == LINES


def test_key_value_lines(spark):
    df = spark.createDataFrame([("row7\tgreen lamp, two chairs",), ("no tab",)], "value string")
    r = S.key_value_lines(df).collect()
    assert (r[0].key, r[0].value) == ("row7", "green lamp, two chairs")
    assert (r[1].key, r[1].value) == ("no tab", "")


def test_n_line_batches(spark, tmp_text):
    b = S.n_line_batches(spark, tmp_text(LINES), 2).groupBy("batch").count().orderBy("batch").collect()
    assert [(x.batch, x["count"]) for x in b] == [(0, 2), (1, 2)]


def test_regex_loader_no_match_is_null(spark, tmp_text):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    r = S.load_regex(spark, tmp_text(["ab 12", "zz"]), r"(\w+) (\d+)", schema).collect()
    assert tuple(r[0]) == ("ab", 12) and tuple(r[1]) == (None, None)


def test_delimited_schema_modes(spark, tmp_text):
    path = tmp_text(["1950\t0\t1", "1950\t22\t1", "1950\te\t1", "1949\t111\t1", "1949\t78\t1"])
    schema = T.StructType([T.StructField("year", T.StringType()),
                           T.StructField("temperature", T.IntegerType()),
                           T.StructField("quality", T.IntegerType())])
    rows = S.load_delimited(spark, path, "\t", schema).collect()
    assert rows[2].temperature is None and rows[2].year == "1950"
    untyped = S.load_delimited(spark, path, "\t")
    assert untyped.columns == ["_c0", "_c1", "_c2"]


def test_short_row_padded(spark, tmp_text):
    path = tmp_text(["2\tTie", "4\tCoat", "3", "1\tScarf"])
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("item", T.StringType())])
    rows = S.load_delimited(spark, path, "\t", schema).collect()
    assert tuple(rows[2]) == (3, None)


def test_nested_delimiters(spark):
    line = "1\x022\x01b\x032\x02a\x031\x01a\x021\x021.0\x011\x0263"
    df = spark.createDataFrame([(line,)], "value string")
    spec = [("c1", "array", "int"), ("c2", "map", "int"), ("c3", "struct:a,b,c", "string,int,double"),
            ("c4", "scalar", "string")]
    r = df.select(*S.nested_columns(F.col("value"), spec)).first()
    assert r.c1 == [1, 2] and r.c2 == {"b": 2, "a": 1}
    assert (r.c3.a, r.c3.b, r.c3.c) == ("a", 1, 1.0)


def test_import_csv(spark, tmp_text):
    path = tmp_text(["1,gizmo,4", "2,null,", "3,widget,x"])
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("version", T.IntegerType())])
    rows = S.parse_import_csv(spark, path, schema).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "gizmo", 4), (2, None, None)]


def test_globs_and_path_filters(spark, tmp_path):
    for d in ["2007/12/30", "2007/12/31", "2008/01/01", "2008/01/02"]:
        p = tmp_path / d
        p.mkdir(parents=True)
        (p / "part.txt").write_text(d + "\n")
    base = str(tmp_path)
    rows = lambda df: sorted(r.value for r in df.collect())
    assert rows(spark.read.text(base + "/2007/*/*")) == ["2007/12/30", "2007/12/31"]
    assert rows(spark.read.text(base + "/{2007/12/31,2008/01/01}")) == ["2007/12/31", "2008/01/01"]
    assert rows(spark.read.text(base + "/200?/*/3[01]")) == ["2007/12/30", "2007/12/31"]
    all_files = spark.read.text(base + "/*/*/*")
    assert rows(S.path_filter(all_files, exclude=r"2007/12/31")) == [
        "2007/12/30", "2008/01/01", "2008/01/02"]
    assert rows(S.date_range_filter(all_files, "2007/12/31".replace("/", "-"), "2008-01-01")) == [
        "2007/12/31", "2008/01/01"]


def test_offsets_and_batches_of_several_files(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.txt").write_bytes(b"".join(f"{name}{i}".encode() * 9 + (b"\r\n" if i % 2 else b"\n") for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")     # several splits of each file
    try:
        want = {}
        for name in "ab":
            data, at = (tmp_path / f"{name}.txt").read_bytes(), 0
            for line in data.splitlines(keepends=True):
                want[line.rstrip().decode()] = at
                at += len(line)
        offsets = S.lines_with_offsets(spark, str(tmp_path))
        assert {r.line: r.offset for r in offsets.collect()} == want
        assert "Python" not in offsets._jdf.queryExecution().toString()
        got = S.n_line_batches(spark, str(tmp_path), 3).collect()
        assert all(r.line == f"{r.line[0]}{r.line_no}" * 9 and r.batch == r.line_no // 3 and r.file.endswith(f"{r.line[0]}.txt") for r in got)
        assert len({(r.file, r.batch) for r in got}) == 2 * 167
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_regex_alternation_is_anchored_whole(spark, tmp_text):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    r = S.load_regex(spark, tmp_text(["axx", "a", "b"]), "(a)|(b)", schema).collect()
    assert [tuple(x) for x in r] == [(None, None), ("a", ""), ("", "b")]


def test_separators_are_literal(spark):
    df = spark.createDataFrame([("k|v|w",)], "value string")
    assert tuple(S.key_value_lines(df, sep="|").first()) == ("k", "v|w")


def test_import_keeps_empty_strings(spark, tmp_text):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    assert [tuple(r) for r in S.parse_import_csv(spark, tmp_text(["1,", "2,null"]), schema).collect()] == [(1, ""), (2, None)]
