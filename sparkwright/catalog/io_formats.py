"""Round trips through every reader and writer.

Each job writes a driver table (or a projection of it) in some layout to a
fresh path in the shared folder, reads it back with the matching reader
and returns the result, so the oracle is the same projection of the
original table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.analogs import lineitem_ncdc_fields
from ..sinks import tables as K
from ..sinks.compaction import compact_by_size
from ..operators.ordering import order_by, order_check
from ..session import scratch_path, table, table_name
from ..sources import text as S
from ..sources.weather import (parse_ncdc, parse_station_metadata, render_ncdc,
                               render_station_metadata)
from .registry import query

NCDC_TEMP_SQL = ("CASE WHEN l_quantity = 50 THEN 9999 "
                 "ELSE CAST(floor(l_extendedprice / 100) AS INT) - 500 END")


def _ncdc_text(spark, sf):
    """Line items rendered as fixed-width weather lines, written as text."""
    f = lineitem_ncdc_fields(table(spark, sf, "lineitem"))
    path = scratch_path(spark, "ncdc")
    render_ncdc(f, F.col("usaf"), F.col("wban"), F.col("observed_at"),
                F.col("temperature"), F.col("quality")).write.text(path)
    return path


@query("fixed_width_roundtrip", f"""
SELECT CAST(year(l_shipdate) AS INT) AS year,
       max(CAST(floor(l_extendedprice / 100) AS INT) - 500) AS max_temperature,
       count(*) AS readings
FROM lineitem WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50 GROUP BY 1""",
       "S01 F01 F10 F12")
def fixed_width_roundtrip(spark, sf):
    """Write weather lines, parse them back, max per year of valid readings."""
    r = parse_ncdc(spark.read.text(_ncdc_text(spark, sf)))
    return (r.where("valid").groupBy("year")
            .agg(F.max("temperature").alias("max_temperature"),
                 F.count(F.lit(1)).alias("readings")))


@query("cut_loader", f"""
SELECT CAST(year(l_shipdate) AS INT) AS year, l_linenumber AS quality,
       max({NCDC_TEMP_SQL}) AS max_temperature, count(*) AS n
FROM lineitem GROUP BY 1, 2""", "S02")
def cut_loader(spark, sf):
    schema = T.StructType([T.StructField("year", T.IntegerType()),
                           T.StructField("temperature", T.IntegerType()),
                           T.StructField("quality", T.IntegerType())])
    r = S.load_cut(spark, _ncdc_text(spark, sf), "16-19,88-92,93-93", schema)
    return r.groupBy("year", "quality").agg(F.max("temperature").alias("max_temperature"),
                                            F.count(F.lit(1)).alias("n"))


def _stations_text(spark, sf):
    s = table(spark, sf, "supplier")
    path = scratch_path(spark, "stations")
    render_station_metadata(s, F.col("s_suppkey"), F.col("s_nationkey"), F.col("s_name")) \
        .write.text(path)
    return path


_STATION_ID_SQL = "lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || '-' || lpad(CAST(s_nationkey AS VARCHAR), 5, '0')"


@query("regex_table", f"""
SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS usaf,
       lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS wban, rtrim(s_name) AS name
FROM supplier""", "S03")
def regex_table(spark, sf):
    schema = T.StructType([T.StructField("usaf", T.StringType()),
                           T.StructField("wban", T.StringType()),
                           T.StructField("name", T.StringType())])
    r = S.load_regex(spark, _stations_text(spark, sf), r"(\d{6}) (\d{5}) (.{29}).*", schema)
    return r.select("usaf", "wban", F.rtrim("name").alias("name"))


@query("dim_load_defaults", f"""
SELECT {_STATION_ID_SQL} AS station_id, rpad(s_name, 29, ' ') AS station_name,
       '(unknown)' AS description, '(unknown)' AS location
FROM supplier""", "K21 S04")
def dim_load_defaults(spark, sf):
    """Station metadata text -> keyed dimension table with default columns."""
    st = parse_station_metadata(spark.read.text(_stations_text(spark, sf)))
    dim = st.select("station_id", "station_name", F.lit("(unknown)").alias("description"),
                    F.lit("(unknown)").alias("location"))
    path = scratch_path(spark, "dim")
    K.parquet(dim, path)
    return spark.read.parquet(path)


@query("delimited_roundtrip", """
SELECT p_partkey, p_name, p_brand, p_size FROM part""", "S06 K02")
def delimited_roundtrip(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    path = scratch_path(spark, "colon")
    K.delimited(p, path, sep=":")
    schema = T.StructType([T.StructField("p_partkey", T.LongType()),
                           T.StructField("p_name", T.StringType()),
                           T.StructField("p_brand", T.StringType()),
                           T.StructField("p_size", T.IntegerType())])
    return S.load_delimited(spark, path, ":", schema)


@query("untyped_load", """
SELECT CAST(p_partkey AS VARCHAR) AS _c0, p_brand AS _c2 FROM part""", "S07")
def untyped_load(spark, sf):
    """No schema: string fields _c0.., positional access $0 and $2."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    path = scratch_path(spark, "untyped")
    K.delimited(p, path, sep="\t")
    df = S.load_delimited(spark, path, "\t")
    return df.select(df.columns[0], df.columns[2])


@query("nested_delims", """
SELECT p_partkey, p_size AS first_item, CAST(p_size + 1 AS INT) AS second_item,
       p_size AS brand_value, p_name AS struct_name
FROM part""", "S08 P26")
def nested_delims(spark, sf):
    """Array / map / struct columns written with nested delimiters, parsed back."""
    p = table(spark, sf, "part")
    arr = F.concat_ws("\x02", F.col("p_size").cast("string"), (F.col("p_size") + 1).cast("string"))
    mp = F.concat(F.col("p_brand"), F.lit("\x03"), F.col("p_size").cast("string"))
    st = F.concat_ws("\x02", F.col("p_name"), F.col("p_size").cast("string"))
    path = scratch_path(spark, "nested")
    p.select(S.render_nested([F.col("p_partkey").cast("string"), arr, mp, st,
                              F.col("p_brand")]).alias("value")).write.text(path)
    spec = [("id", "scalar", "bigint"), ("items", "array", "int"), ("sizes", "map", "int"),
            ("info", "struct:name,size", "string,int"), ("brand", "scalar", "string")]
    r = spark.read.text(path).select(*S.nested_columns(F.col("value"), spec))
    return r.select(F.col("id").alias("p_partkey"),
                    F.get("items", 0).alias("first_item"), F.get("items", 1).alias("second_item"),
                    F.col("sizes")[F.col("brand")].alias("brand_value"),
                    F.col("info.name").alias("struct_name"))


def _doc_lines_path(spark, sf):
    """Documents as 'doc_id<TAB>line_no<TAB>line' text, each doc's lines
    contiguous and in order within its file."""
    d = table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    path = scratch_path(spark, "doclines")
    (d.repartition("doc_id").sortWithinPartitions("doc_id", "line_no")
     .select(F.concat_ws("\t", F.col("doc_id").cast("string"), F.col("line_no").cast("string"),
                         "line").alias("value"))
     .write.text(path))
    return path


_DOC_LINES_SQL = """
WITH l AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT)
                  AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)"""


@query("byte_offsets", _DOC_LINES_SQL + """
SELECT doc_id, line_no, CAST(coalesce(sum(strlen(CAST(doc_id AS VARCHAR) || chr(9) ||
         CAST(line_no AS VARCHAR) || chr(9) || line) + 1) OVER (PARTITION BY doc_id
         ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
       AS offset_in_doc
FROM l""", "S09 K06 P22")
def byte_offsets(spark, sf):
    """Lines with their byte offsets, stored as parquet (offset, line);
    offsets are reported relative to each doc's first line."""
    lines = S.lines_with_offsets(spark, _doc_lines_path(spark, sf))
    path = scratch_path(spark, "offsets")
    K.parquet(lines, path)
    r = spark.read.parquet(path)
    parts = F.split("line", "\t", 3)
    r = r.select(F.get(parts, 0).cast("long").alias("doc_id"),
                 F.get(parts, 1).cast("long").alias("line_no"), "offset")
    first = r.groupBy("doc_id").agg(F.min("offset").alias("base"))
    return r.join(first, "doc_id").select("doc_id", "line_no",
                                          (F.col("offset") - F.col("base")).alias("offset_in_doc"))


@query("key_value_lines", _DOC_LINES_SQL + """
SELECT CAST(doc_id AS VARCHAR) AS key, CAST(line_no AS VARCHAR) || chr(9) || line AS value
FROM l""", "S10 K01")
def key_value_lines(spark, sf):
    return S.key_value_lines(spark.read.text(_doc_lines_path(spark, sf)))


@query("n_line_batches", _DOC_LINES_SQL + """, p AS (
  SELECT lang, CAST(doc_id % 16 AS INT) AS split, count(*) AS n FROM l JOIN documents USING (doc_id) GROUP BY 1, 2)
SELECT lang, split, n AS lines, CAST(ceil(n / 100.0) AS BIGINT) AS batches, CAST(n - 100 * (ceil(n / 100.0) - 1) AS BIGINT) AS last_batch
FROM p""", "S11")
def n_line_batches(spark, sf):
    """Sixteen tasks write a file for each language; batches of 100 lines don't cross files."""
    split = (F.col("doc_id") % 16).cast("int")
    d = table(spark, sf, "documents").select("lang", split.alias("split"), F.explode(F.split("text", "\n")).alias("value"))
    path = scratch_path(spark, "lines-by-lang")
    d.repartitionById(16, F.col("split")).write.partitionBy("lang", "split").text(path)
    part = [F.regexp_extract("file", rf"{c}=([^/]+)/", 1).alias(c) for c in ("lang", "split")]
    b = S.n_line_batches(spark, path + "/*/*/*.txt", 100).select("*", *part)
    per = b.groupBy("lang", "split", "batch").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("lang", F.col("split").cast("int").alias("split")).agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("batches"), F.max_by("n", "batch").alias("last_batch"))


@query("kv_text_output", """
SELECT CAST(l_suppkey AS VARCHAR) AS key, CAST(CAST(floor(max(l_extendedprice)) AS BIGINT) AS VARCHAR) || chr(9) || CAST(count(*) AS VARCHAR) AS value
FROM lineitem GROUP BY l_suppkey""", "K01 S10")
def kv_text_output(spark, sf):
    """The default output of a job: key, tab, values; read back as lines split at the first tab."""
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.floor(F.max("l_extendedprice")).cast("long").alias("top"), F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "kv")
    K.kv_text(per, "l_suppkey", ["top", "n"], path)
    return S.key_value_lines(spark.read.text(path))


@query("whole_files", """
SELECT lang, CAST(sum(strlen(replace(text, chr(10), ' ')) + 1) AS BIGINT) AS bytes
FROM documents GROUP BY 1""", "S12")
def whole_files(spark, sf):
    d = table(spark, sf, "documents").select("lang", F.regexp_replace("text", "\n", " ")
                                             .alias("value"))
    path = scratch_path(spark, "docs-by-lang")
    d.write.partitionBy("lang").text(path)
    w = S.whole_files(spark, path + "/*/*.txt")
    return (w.withColumn("lang", F.regexp_extract("path", r"lang=([^/]+)/", 1))
            .groupBy("lang").agg(F.sum(F.octet_length("content")).cast("long").alias("bytes")))


def _by_date_path(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.date_format("l_shipdate", "yyyy").alias("y"), F.date_format("l_shipdate", "MM").alias("m"),
        F.date_format("l_shipdate", "dd").alias("d"))
    path = scratch_path(spark, "bydate")
    K.by_key(li, path, ["y", "m"])
    return path


@query("glob_paths", """
SELECT CAST(year(l_shipdate) AS INT) AS year, count(*) AS n FROM lineitem
WHERE year(l_shipdate) IN (1995, 1996) GROUP BY 1""", "S13")
def glob_paths(spark, sf):
    """Brace and character-class globs select the input directories."""
    path = _by_date_path(spark, sf)
    df = spark.read.option("basePath", path).parquet(path + "/y={1995,1996}/m=[01][0-9]")
    return df.groupBy(F.col("y").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("path_filters", """
SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1996-12-30' AND TIMESTAMP '1997-01-02'
   OR (year(l_shipdate) = 1998 AND month(l_shipdate) <> 12)
GROUP BY 1""", "S14")
def path_filters(spark, sf):
    """A date range, both ends inclusive, over the year/month folders (pruned
    at planning by a predicate of their own) and the day column; plus
    include / exclude regexes on the file path."""
    path = _by_date_path(spark, sf)
    df = spark.read.parquet(path)
    in_range = S.partition_date_range(df, "1996-12-30", "1997-01-02")
    by_regex = S.path_filter(df, include=r"/y=1998/", exclude=r"/m=12/")
    both = in_range.unionByName(by_regex)
    month = F.format_string("%04d-%02d", F.col("y").cast("int"), F.col("m").cast("int"))
    return both.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("n"))


@query("gzip_text", f"""
SELECT CAST(year(l_shipdate) AS INT) AS year,
       max(CAST(floor(l_extendedprice / 100) AS INT) - 500) AS max_temperature
FROM lineitem WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50 GROUP BY 1""",
       "S21 K03")
def gzip_text(spark, sf):
    """Weather text compacted into gzip files per year, read back by suffix."""
    lines = spark.read.text(_ncdc_text(spark, sf))
    path = scratch_path(spark, "gz")
    (lines.withColumn("year", F.substring("value", 16, 4)).hint("rebalance", F.col("year"))
     .write.partitionBy("year").option("compression", "gzip").text(path))
    back = parse_ncdc(spark.read.text(path + "/year=*/*.gz"))
    return back.where("valid").groupBy("year").agg(F.max("temperature").alias("max_temperature"))


@query("archive_compaction", """
SELECT CAST(year(l_shipdate) AS INT) AS year, count(*) AS lines,
       CAST(sum(CAST(l_orderkey AS BIGINT)) AS BIGINT) AS keys FROM lineitem GROUP BY 1""", "K11")
def archive_compaction(spark, sf):
    """Many gzip files, with the year in their path only, into larger gzip files by year."""
    src, out = scratch_path(spark, "archive"), scratch_path(spark, "archive-packed")
    li = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("y"), F.col("l_orderkey").cast("string").alias("value"))
    li.repartition(16).write.partitionBy("y").option("compression", "gzip").text(src)
    year = F.regexp_extract(F.col("_metadata.file_path"), r"/y=(\d{4})/", 1).cast("int")
    lines = spark.read.text(src + "/*/*.gz").select("value", year.alias("year"))
    (lines.hint("rebalance", F.col("year")).write.partitionBy("year").option("compression", "gzip").text(out))
    return spark.read.text(out).groupBy("year").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("value").cast("long")).alias("keys"))


@query("seqfile_order", "SELECT count(*) AS rows, 0 AS inversions FROM part", "O15")
def seqfile_order(spark, sf):
    """Rows and wrong neighbours of the pair file sorted by its key."""
    return order_check(seqfile_roundtrip(spark, sf), ["key", "value"])


@query("quoted_delimited", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN '"' || p_name ELSE p_name || '"x' END AS name,
       p_size FROM part""", "S06 S07 K02 S20")
def quoted_delimited(spark, sf):
    """Quotes and empty strings in delimited text are data."""
    p = table(spark, sf, "part")
    name = (F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.concat(F.lit('"'), "p_name"))
            .otherwise(F.concat("p_name", F.lit('"x'))))
    path = scratch_path(spark, "quoted")
    K.delimited(p.select("p_partkey", name.alias("name"), "p_size"), path, sep="\t")
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("p_size", T.IntegerType())])
    return S.load_delimited(spark, path, "\t", schema)


@query("seqfile_roundtrip", "SELECT p_size AS key, p_name AS value FROM part", "S15 K04 O15")
def seqfile_roundtrip(spark, sf):
    """(int, text) pairs as a block-compressed SequenceFile, read back and
    sorted by key (range partitioned; part files concatenate in order)."""
    p = table(spark, sf, "part").select(F.col("p_size").alias("key"), F.col("p_name").alias("value"))
    path = scratch_path(spark, "seq")
    K.sequence_file(p, "key", "value", path)
    back = S.sequence_file(spark, path)
    return order_by(back.select(F.col("key").cast("int").alias("key"), "value"), ["key", "value"])


@query("seqfile_valid_readings", f"""
SELECT {NCDC_TEMP_SQL} AS temperature, CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) AS line
FROM lineitem WHERE l_quantity <> 50 AND l_linenumber IN (0, 1, 4, 5, 9)""", "K04 S15")
def seqfile_valid_readings(spark, sf):
    """Readings that are there and of good quality as gzip-compressed (temperature, line) pairs; the others are not written."""
    li = table(spark, sf, "lineitem")
    line = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    temperature = F.when(F.col("l_quantity") == 50, 9999).otherwise((F.floor(F.col("l_extendedprice") / 100) - 500).cast("int"))
    pairs = li.select(temperature.alias("temperature"), line.alias("line"), F.col("l_linenumber").alias("quality"))
    valid = pairs.where((F.col("temperature") != 9999) & F.col("quality").isin(0, 1, 4, 5, 9))
    path = scratch_path(spark, "valid-pairs")
    K.sequence_file(valid, "temperature", "line", path, "org.apache.hadoop.io.compress.GzipCodec")
    return S.sequence_file(spark, path, "temperature", "line").select(F.col("temperature").cast("int").alias("temperature"), "line")


@query("parquet_text", "SELECT p_partkey, p_name, p_size FROM part", "S17 K23")
def parquet_text(spark, sf):
    """Parquet -> JSON text lines -> parsed back."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    pq, js = scratch_path(spark, "pq"), scratch_path(spark, "json")
    K.parquet(p, pq)
    K.json_lines(spark.read.parquet(pq), js)
    return spark.read.schema("p_partkey long, p_name string, p_size int").json(js)


@query("orc_roundtrip", """
SELECT n_nationkey, n_name, count(*) AS suppliers FROM supplier
JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""", "S18 K07")
def orc_roundtrip(spark, sf):
    """CREATE TABLE ... USING orc AS SELECT, then read the ORC files."""
    path = scratch_path(spark, "orc")
    name = table_name("orc_ctas")
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    spark.sql(f"CREATE TABLE {name} USING orc LOCATION '{path}' AS "
              "SELECT n_nationkey, n_name, count(*) AS suppliers FROM {s} "
              "JOIN {n} ON s_nationkey = n_nationkey GROUP BY 1, 2", s=s, n=n)
    return spark.read.orc(path)


@query("ctas_formats", """
SELECT format, n_nationkey, n_name, suppliers FROM (
  SELECT n_nationkey, n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
  (VALUES ('parquet'), ('orc'), ('json'), ('csv')) f(format)""", "K07")
def ctas_formats(spark, sf):
    """CREATE TABLE AS SELECT into each file format of a table; each is read as a table."""
    s, n, out = table(spark, sf, "supplier"), table(spark, sf, "nation"), None
    for fmt in ("parquet", "orc", "json", "csv"):
        name = table_name(f"{fmt}_ctas")
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{scratch_path(spark, fmt)}' AS "
                  "SELECT n_nationkey, n_name, count(*) AS suppliers FROM {s} "
                  "JOIN {n} ON s_nationkey = n_nationkey GROUP BY 1, 2", s=s, n=n)
        t = spark.table(name).select(F.lit(fmt).alias("format"), "n_nationkey", "n_name", "suppliers")
        out = t if out is None else out.unionByName(t)
    return out


@query("null_csv", """
SELECT p_partkey AS id, CASE WHEN p_size > 45 THEN NULL ELSE p_name END AS name,
       CASE WHEN p_size < 5 THEN NULL ELSE p_size END AS size
FROM part WHERE p_brand <> 'Brand#1'""", "S20")
def null_csv(spark, sf):
    """Imported CSV: 'null' strings, empty numbers, bad rows skipped."""
    p = table(spark, sf, "part")
    name = F.when(F.col("p_size") > 45, F.lit("null")).otherwise(F.col("p_name"))
    size = (F.when(F.col("p_brand") == "Brand#1", F.concat(F.lit("x"), F.col("p_size")))
            .when(F.col("p_size") < 5, F.lit("")).otherwise(F.col("p_size").cast("string")))
    path = scratch_path(spark, "import")
    p.select(F.concat_ws(",", F.col("p_partkey").cast("string"), name, size).alias("v")) \
        .write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("name", T.StringType()),
                           T.StructField("size", T.IntegerType())])
    return S.parse_import_csv(spark, path, schema)


@query("partition_by_key", """
SELECT l_suppkey AS station, count(*) AS n, max(l_extendedprice) AS max_temperature
FROM lineitem GROUP BY 1""", "K08")
def partition_by_key(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("station"),
                                             "l_extendedprice")
    path = scratch_path(spark, "bystation")
    K.by_key(li, path, ["station"])
    return spark.read.parquet(path).groupBy("station").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("max_temperature"))


@query("partition_by_key_year", """
SELECT l_suppkey AS station, CAST(year(l_shipdate) AS INT) AS year, count(*) AS n
FROM lineitem GROUP BY 1, 2""", "K09")
def partition_by_key_year(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("station"),
                                             F.year("l_shipdate").alias("year"), "l_orderkey")
    path = scratch_path(spark, "bystationyear")
    K.by_key(li, path, ["station", "year"])
    return spark.read.parquet(path).groupBy("station", "year").agg(F.count(F.lit(1)).alias("n"))


def _loaded_partitions(spark, sf):
    """Every kind of event loaded into a literal partition of its own (a handful of kinds)."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    path = scratch_path(spark, "static")
    for kind in [r.event_type for r in e.select("event_type").distinct().collect()]:
        K.static_partition(e.where(F.col("event_type") == kind).drop("event_type"), path, {"event_type": kind})
    return path


@query("static_partitions", """
SELECT event_id, user_id, 'view' AS event_type FROM events WHERE event_type = 'view'""",
       "K17 P27")
def static_partitions(spark, sf):
    """One of the loaded partitions is read; the others are pruned."""
    return spark.read.parquet(_loaded_partitions(spark, sf)).where(F.col("event_type") == "view")


@query("static_partitions_all", """
SELECT event_id, user_id, event_type, (SELECT count(DISTINCT event_type) FROM events) AS partitions FROM events""", "K17")
def static_partitions_all(spark, sf):
    """All loaded partitions, and how many of them the listing shows."""
    path = _loaded_partitions(spark, sf)
    n = K.list_partitions(spark, path, ["event_type"]).count()
    return spark.read.parquet(path).withColumn("partitions", F.lit(n).cast("long"))


@query("small_file_compaction", """
SELECT count(*) AS pages, CAST(sum(strlen(replace(html, chr(10), ' ')) + 1) AS BIGINT) AS bytes
FROM pages""", "K10")
def small_file_compaction(spark, sf):
    """Many small files packed into few (file name, bytes) parquet files."""
    src = scratch_path(spark, "small")
    (table(spark, sf, "pages").select(F.regexp_replace("html", "\n", " ").alias("value"))
     .repartition(32).write.text(src))
    out = scratch_path(spark, "packed")
    K.compact(spark, src + "/*.txt", out)
    packed = spark.read.parquet(out)
    lines = F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: x != "")
    return packed.agg(F.sum(F.size(lines)).cast("long").alias("pages"),
                      F.sum(F.length("content")).cast("long").alias("bytes"))


@query("compaction_by_size", """
SELECT count(*) AS pages, CAST(sum(strlen(replace(html, chr(10), ' ')) + 1) AS BIGINT) AS bytes, true AS within_target, true AS few
FROM pages""", "K10")
def compaction_by_size(spark, sf):
    """Files of very different sizes, one of them with a third of the pages: outputs stay within 1.2 of the target."""
    src, out = scratch_path(spark, "uneven"), scratch_path(spark, "by-size")
    pages = table(spark, sf, "pages").select("page_id", F.regexp_replace("html", "\n", " ").alias("value"))
    file = F.when(F.col("page_id") % 3 == 0, 0).otherwise(F.floor(F.sqrt(F.pmod(F.xxhash64("page_id"), F.lit(1600)))).cast("int"))
    pages.repartitionById(40, file).select("value").write.text(src)
    total = spark.read.format("binaryFile").load(src + "/*.txt").agg(F.sum("length")).first()[0]
    target = total // 8
    files = compact_by_size(spark, src + "/*.txt", out, target)
    packed = spark.read.parquet(out).withColumn("output", F.col("_metadata.file_path"))
    lines = F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: x != "")
    size = F.sum(F.length("content"))
    per = packed.groupBy("output").agg(size.alias("bytes"), F.count(F.lit(1)).alias("files"), F.sum(F.size(lines)).alias("pages"))
    return per.agg(F.sum("pages").cast("long").alias("pages"), F.sum("bytes").cast("long").alias("bytes"),
                   F.every((F.col("bytes") <= 1.2 * target) | (F.col("files") == 1)).alias("within_target"),
                   ((F.count(F.lit(1)) == files) & (F.count(F.lit(1)) <= 14)).alias("few"))


@query("table_overwrite", "SELECT p_partkey, p_name, true AS was_listed, false AS is_listed FROM part WHERE p_size >= 10", "K18")
def table_overwrite(spark, sf):
    """Create, load, overwrite and drop a table: the second load replaces the first, the files of an external table stay."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    path = scratch_path(spark, "overwrite")
    name = table_name("overwrite")
    p.where(F.col("p_size") < 10).write.mode("overwrite").option("path", path).saveAsTable(name)
    p.where(F.col("p_size") >= 10).write.mode("overwrite").option("path", path).saveAsTable(name)
    listed = [spark.catalog.tableExists(name)]
    spark.sql(f"DROP TABLE {name}")
    listed.append(spark.catalog.tableExists(name))
    return spark.read.parquet(path).select("p_partkey", "p_name", F.lit(listed[0]).alias("was_listed"), F.lit(listed[1]).alias("is_listed"))


@query("write_modes", "SELECT p_partkey, p_size FROM part", "K14")
def write_modes(spark, sf):
    """errorifexists refuses an existing path; append adds; ignore keeps."""
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    path = scratch_path(spark, "modes")
    K.write_mode(p.where(F.col("p_size") < 10), path, "errorifexists")
    try:
        K.write_mode(p, path, "errorifexists")
        raise AssertionError("errorifexists wrote over an existing path")
    except Exception as e:  # AnalysisException: path already exists
        if isinstance(e, AssertionError):
            raise
    K.write_mode(p.where(F.col("p_size") >= 10), path, "append")
    return K.write_mode(p.where(F.lit(False)), path, "ignore")


@query("checkpoint_reuse", """
SELECT p_brand, count(*) AS n FROM part GROUP BY 1""", "K15 G02")
def checkpoint_reuse(spark, sf):
    """Intermediate written once; a second run finds it newer than its input
    and reads it instead of recomputing."""
    agg = table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "ckpt")
    K.checkpointed(agg, path, inputs=[f"{sf}/part.parquet"])
    # an empty plan on the second run proves the stored copy is what comes back
    return K.checkpointed(agg.where(F.lit(False)), path, inputs=[f"{sf}/part.parquet"])
