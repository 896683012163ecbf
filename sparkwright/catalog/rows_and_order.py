"""Projections, filters, sorts, unions and samples over part / lineitem /
customer / supplier / events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ordering as O
from ..operators import projection as P
from ..operators import schema_resolution as N
from ..operators import sets as U
from ..sinks.tables import bucketed_table, parquet
from ..session import scratch_path, table, table_name
from .registry import query

# --- projections and filters ---------------------------------------------


@query("project_exprs", """
SELECT p_partkey AS f0, CAST(p_size + 1 AS INT) AS f1, 'Constant' AS f2,
       TRY_CAST(substr(p_brand, 7) AS INT) AS brand_no,
       CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS big
FROM part""", "P01 P02 P03")
def project_exprs(spark, sf):
    p = table(spark, sf, "part")
    return p.select(P.positional(p, 0).alias("f0"), (P.positional(p, 4) + 1).alias("f1"),
                    F.lit("Constant").alias("f2"),
                    F.substring("p_brand", 7, 10).try_cast("int").alias("brand_no"),
                    F.when(F.col("p_size") > 25, 1).otherwise(0).alias("big"))


@query("project_all", "SELECT * FROM part", "P04")
def project_all(spark, sf):
    return table(spark, sf, "part").select("*")


@query("split_relation", """
SELECT CASE WHEN p_size >= 25 THEN 'large' ELSE 'small' END AS branch, p_partkey, p_size
FROM part""", "P11 K13")
def split_relation(spark, sf):
    """SPLIT part INTO large IF p_size >= 25, small OTHERWISE: one scan and
    one write, with a folder for each branch."""
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    branch = F.when(F.col("p_size") >= 25, "large").otherwise("small")
    path = scratch_path(spark, "split")
    parquet(p.withColumn("branch", branch), path, partition_by=["branch"])
    return (spark.read.parquet(f"{path}/branch=large").select(F.lit("large").alias("branch"), "*")
            .unionByName(spark.read.parquet(f"{path}/branch=small").select(F.lit("small").alias("branch"), "*")))


@query("key_by_swap", """
SELECT p_name AS key, CAST(length(p_name) AS INT) AS value FROM part""", "P15 P16 P17")
def key_by_swap(spark, sf):
    """Key each name by its length, keep values, then invert the pairs."""
    p = table(spark, sf, "part").select("p_name")
    keyed = P.key_by(p, F.length("p_name")).select("key", F.col("p_name").alias("value"))
    return P.swap(keyed)


@query("range_filter", "SELECT p_partkey, p_size FROM part WHERE p_size >= 10", "P10")
def range_filter(spark, sf):
    return table(spark, sf, "part").where(F.col("p_size") >= 10).select("p_partkey", "p_size")


@query("string_filter", """
SELECT p_partkey, p_type FROM part WHERE p_type = 'SMALL'""", "P09")
def string_filter(spark, sf):
    return table(spark, sf, "part").where(F.col("p_type") == "SMALL").select("p_partkey", "p_type")


@query("derived_filter", """
SELECT p_partkey, upper(p_name) AS name_upper FROM part WHERE length(p_name) % 2 = 0""",
       "P12 P13")
def derived_filter(spark, sf):
    """Filter on a derived value (even name length), then a 1:1 map."""
    p = table(spark, sf, "part")
    return (p.where(F.length("p_name") % 2 == 0)
            .select("p_partkey", F.upper("p_name").alias("name_upper")))


@query("short_rows", """
SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)),
                                    lambda x: len(string_split(x, ' ')) > 1)) AS INT) AS wide_lines
FROM documents""", "P08 F07")
def short_rows(spark, sf):
    """Per document, the lines with more than one field (short rows dropped)."""
    d = table(spark, sf, "documents")
    lines = F.split("text", "\n")
    return d.select("doc_id", F.size(F.filter(lines, lambda x: F.size(F.split(x, " ")) > 1))
                    .alias("wide_lines"))


@query("null_tests_with_nulls", """
SELECT count(*) FILTER (WHERE v IS NULL) AS null_rows, count(*) FILTER (WHERE v IS NOT NULL) AS good_rows
FROM (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events)""", "P07")
def null_tests_with_nulls(spark, sf):
    """IS NULL and IS NOT NULL over a written column that holds nulls."""
    path = scratch_path(spark, "nulls")
    parquet(table(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("value")).alias("v")), path)
    v = spark.read.parquet(path)
    return v.agg(F.count_if(F.col("v").isNull()).alias("null_rows"), F.count_if(F.col("v").isNotNull()).alias("good_rows"))


@query("null_tests", """
SELECT count(*) FILTER (WHERE TRY_CAST(substr(p_brand, 7) AS INT) IS NULL) AS null_rows,
       count(*) FILTER (WHERE TRY_CAST(substr(p_brand, 7) AS INT) IS NOT NULL) AS good_rows
FROM part""", "P07 F15")
def null_tests(spark, sf):
    p = table(spark, sf, "part").select(F.substring("p_brand", 7, 10).try_cast("int").alias("b"))
    return p.agg(F.count_if(F.col("b").isNull()).alias("null_rows"),
                 F.count_if(F.col("b").isNotNull()).alias("good_rows"))


# --- reader schemas --------------------------------------------------------

def _part_copy(spark, sf):
    path = scratch_path(spark, "part-copy")
    parquet(table(spark, sf, "part"), path)
    return path


@query("column_subset", "SELECT p_partkey, p_name FROM part", "P18")
def column_subset(spark, sf):
    """Read with a narrower schema: only two columns reach the scan."""
    reader = T.StructType([T.StructField("p_partkey", T.LongType()),
                           T.StructField("p_name", T.StringType())])
    return P.read_parquet_as(spark, _part_copy(spark, sf), reader)


@query("added_column", """
SELECT p_partkey, p_name, '' AS description, CAST(NULL AS VARCHAR) AS note FROM part""", "P19")
def added_column(spark, sf):
    """Reader schema adds 'description' (default '') and 'note' (null)."""
    reader = T.StructType([T.StructField("p_partkey", T.LongType()),
                           T.StructField("p_name", T.StringType()),
                           T.StructField("description", T.StringType()),
                           T.StructField("note", T.StringType())])
    return P.read_parquet_as(spark, _part_copy(spark, sf), reader, defaults={"description": ""})


@query("renamed_columns", "SELECT p_name AS first, p_brand AS second FROM part", "P20")
def renamed_columns(spark, sf):
    """Reader fields 'first'/'second' alias the writer's p_name/p_brand."""
    reader = T.StructType([T.StructField("first", T.StringType()),
                           T.StructField("second", T.StringType())])
    return P.read_parquet_as(spark, _part_copy(spark, sf), reader,
                             aliases={"first": ["p_name"], "second": ["p_brand"]})


# --- sorts -------------------------------------------------------------------

@query("order_by", "SELECT p_size, p_retailprice, p_partkey FROM part ORDER BY 1, 2 DESC, 3",
       "O01 O08")
def order_by(spark, sf):
    p = table(spark, sf, "part").select("p_size", "p_retailprice", "p_partkey")
    return O.order_by(p, ["p_size", "p_retailprice", "p_partkey"], [True, False, True])


@query("limit_k", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""",
       "O02 O10")
def limit_k(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return O.top_k(p, 10, ["p_retailprice"], [False])


@query("bottom_k", """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 2""", "O10")
def bottom_k(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return O.top_k(c, 2, ["c_acctbal"], [True])


@query("distribute_sort", """
SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber FROM lineitem""", "O03")
def distribute_sort(spark, sf):
    spark_df = table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice",
                                                   "l_orderkey", "l_linenumber")
    return spark.sql("SELECT * FROM {t} DISTRIBUTE BY l_suppkey SORT BY l_suppkey, "
                     "l_extendedprice DESC", t=spark_df)


@query("hash_sort", "SELECT l_extendedprice AS temperature, l_orderkey, l_linenumber FROM lineitem",
       "O04")
def hash_sort(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("temperature"),
                                             "l_orderkey", "l_linenumber")
    return O.distribute_sort(li, ["temperature"], ["temperature"])


@query("total_sort", "SELECT l_extendedprice AS temperature, l_orderkey, l_linenumber FROM lineitem",
       "O06")
def total_sort(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("temperature"),
                                             "l_orderkey", "l_linenumber")
    return O.total_sort(li, ["temperature"])


@query("range_balance", None, "O06")
def range_balance(spark, sf):
    """Rows per range partition (4 sampled ranges on the price)."""
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_orderkey", "l_linenumber")
    return O.partition_sizes(O.total_sort(li, ["l_extendedprice"], partitions=4))


@query("range_balance_check", "SELECT count(*) AS rows, true AS within_target FROM lineitem", "O06")
def range_balance_check(spark, sf):
    """The largest of four ranges holds at most 1.2 times the mean (BASELINE)."""
    n = F.col("n")
    return range_balance(spark, sf).agg(F.sum(n).alias("rows"), (F.max(n) <= 1.2 * F.sum(n) / 4).alias("within_target"))


@query("secondary_sort", """
SELECT year, temperature, station_id FROM (
  SELECT CAST(year(l_shipdate) AS INT) AS year, l_extendedprice AS temperature,
         l_suppkey AS station_id,
         row_number() OVER (PARTITION BY year(l_shipdate)
                            ORDER BY l_extendedprice DESC, l_suppkey DESC) AS rn
  FROM lineitem WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50) WHERE rn = 1""",
       "O05")
def secondary_sort(spark, sf):
    """First record per year by temperature descending (window, limit 1)."""
    li = table(spark, sf, "lineitem")
    r = li.where(F.col("l_linenumber").isin(0, 1, 4, 5, 9) & (F.col("l_quantity") != 50)).select(
        F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("temperature"),
        F.col("l_suppkey").alias("station_id"))
    return O.first_per_group(r, ["year"], [F.col("temperature").desc(), F.col("station_id").desc()])


@query("pair_sort", """
SELECT CAST(year(l_shipdate) AS INT) AS year, l_extendedprice AS temperature FROM lineitem
ORDER BY 1, 2 DESC""", "O07 O09")
def pair_sort(spark, sf):
    li = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"),
                                             F.col("l_extendedprice").alias("temperature"))
    return O.order_by(li, ["year", "temperature"], [True, False])


@query("schema_sort", """
SELECT p_brand, p_size, p_name FROM part ORDER BY p_brand, p_size DESC""", "O12")
def schema_sort(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_size", "p_name")
    return O.schema_sort(p, {"p_brand": O.ASCENDING, "p_size": O.DESCENDING,
                             "p_name": O.IGNORE})


@query("field_spec_sort", """
SELECT CAST(l_linenumber AS VARCHAR) || chr(9) || CAST(l_quantity AS VARCHAR) AS line
FROM lineitem""", "O13")
def field_spec_sort(spark, sf):
    li = table(spark, sf, "lineitem").select(F.concat_ws(
        "\t", F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("string")).alias("line"))
    return O.field_spec_sort(li, "line", "-k1n -k2nr")


def _order_sql(source: str) -> str:
    return f"SELECT count(*) AS rows, 0 AS inversions FROM {source}"


@query("order_by_order", _order_sql("part"), "O01 O08")
def order_by_order(spark, sf):
    """Rows and wrong neighbours in the sorted output; so are the queries below."""
    return O.order_check(order_by(spark, sf), ["p_size", "p_retailprice", "p_partkey"], [True, False, True])


@query("distribute_sort_order", _order_sql("lineitem"), "O03")
def distribute_sort_order(spark, sf):
    return O.order_check(distribute_sort(spark, sf), ["l_suppkey", "l_extendedprice"], [True, False], across=False)


@query("distribute_sort_keys", "SELECT count(DISTINCT l_suppkey) AS keys, 0 AS keys_in_two_partitions FROM lineitem", "O03 O14")
def distribute_sort_keys(spark, sf):
    """All rows of a key are in one partition."""
    d = distribute_sort(spark, sf).select("l_suppkey", F.spark_partition_id().alias("part"))
    per = d.groupBy("l_suppkey").agg(F.count_distinct("part").alias("parts"))
    return per.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("parts") > 1).alias("keys_in_two_partitions"))


@query("hash_sort_order", _order_sql("lineitem"), "O04")
def hash_sort_order(spark, sf):
    return O.order_check(hash_sort(spark, sf), ["temperature"], across=False)


@query("total_sort_order", _order_sql("lineitem"), "O06")
def total_sort_order(spark, sf):
    return O.order_check(total_sort(spark, sf), ["temperature"])


@query("pair_sort_order", _order_sql("lineitem"), "O07 O09")
def pair_sort_order(spark, sf):
    return O.order_check(pair_sort(spark, sf), ["year", "temperature"], [True, False])


@query("schema_sort_order", _order_sql("part"), "O12")
def schema_sort_order(spark, sf):
    return O.order_check(schema_sort(spark, sf), ["p_brand", "p_size"], [True, False])


@query("field_spec_sort_order", _order_sql("lineitem"), "O13")
def field_spec_sort_order(spark, sf):
    number = [F.get(F.split("line", "\t"), i).cast("double").alias(f"k{i}") for i in (0, 1)]
    return O.order_check(field_spec_sort(spark, sf).select(*number), ["k0", "k1"], [True, False])


@query("partition_of_check", "SELECT count(*) AS rows, 0 AS mismatches FROM lineitem", "O14")
def partition_of_check(spark, sf):
    """The computed partition against the one that repartition(8, key) gives."""
    li = table(spark, sf, "lineitem").select("l_suppkey").repartition(8, "l_suppkey")
    wrong = F.spark_partition_id() != O.partition_of("l_suppkey", 8)
    return li.select(wrong.alias("wrong")).agg(F.count(F.lit(1)).alias("rows"), F.count_if("wrong").alias("mismatches"))


@query("partition_of", None, "O14")
def partition_of(spark, sf):
    """Rows per hash partition of the station key (what repartition(8, key) does)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(O.partition_of("l_suppkey", 8).alias("partition")).agg(
        F.count(F.lit(1)).alias("n"))


@query("latest_n", """
SELECT user_id, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn <= 3""", "O11")
def latest_n(spark, sf):
    """Latest three observations per user (station)."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return O.first_per_group(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3)


# --- unions and samples ----------------------------------------------------

@query("union_same", """
SELECT s_name AS name, s_nationkey AS nationkey FROM supplier
UNION ALL SELECT c_name, c_nationkey FROM customer""", "U01")
def union_same(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nationkey"))
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nationkey"))
    return U.union_all([s, c])


@query("union_widths", """
SELECT CAST(s_suppkey AS VARCHAR) AS f0, s_name AS f1, CAST(s_nationkey AS VARCHAR) AS f2,
       CAST(NULL AS VARCHAR) AS f3 FROM supplier
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment
FROM customer""", "U02")
def union_widths(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return U.union_positional([s, c])


@query("bucket_sample", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey % 4 = 0""", "U05 K16")
def bucket_sample(spark, sf):
    """Write customers as a bucketed, sorted table; sample bucket 1 of 4."""
    t = bucketed_table(table(spark, sf, "customer").select("c_custkey", "c_name"), table_name("customer_buckets"), 4,
                       "c_custkey", sort_by="c_custkey",
                       path=scratch_path(spark, "bucketed"))
    return U.bucket_sample(t, "c_custkey", 1, 4)


@query("random_sample_check", "SELECT true AS is_subset, true AS share_in_range FROM (SELECT 1)", "U06")
def random_sample_check(spark, sf):
    """The sample holds rows of the table only, each once, and about half of them."""
    c = table(spark, sf, "customer")
    n = c.count()
    kept = random_sample(spark, sf).join(c.select("c_custkey"), "c_custkey", "left_semi")
    whole = random_sample(spark, sf).agg(F.count(F.lit(1)).alias("m")).first().m
    m, d = F.count(F.lit(1)), F.count_distinct("c_custkey")
    return kept.agg(((m == whole) & (d == whole)).alias("is_subset"), m.between(0.4 * n, 0.6 * n).alias("share_in_range"))


@query("random_sample", None, "U06")
def random_sample(spark, sf):
    return U.random_sample(table(spark, sf, "customer"), 0.5, seed=7)


# --- nested reader schemas -------------------------------------------------------

@query("nested_reader_schema", """
SELECT event_id, user_id AS who, event_type AS kind, 'unknown' AS source, CAST(value AS DOUBLE) AS amount,
       [upper(event_type), 'x'] AS labels, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE) AS k, true AS whole
FROM events""", "P18 P19 P20")
def nested_reader_schema(spark, sf):
    """Events stored as nested records, read through a schema that renames, widens, adds and drops at depth."""
    e = table(spark, sf, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("int")
    path = scratch_path(spark, "nested")
    e.select("event_id", F.struct(F.col("user_id").cast("int").alias("id"), F.col("event_type").alias("type"), "props").alias("user"),
             F.struct(F.col("value"), F.array(F.struct(F.upper("event_type").alias("name"), F.lit(1).alias("rank")),
                                              F.struct(F.lit("x").alias("name"), F.lit(2).alias("rank"))).alias("tags")).alias("body"),
             F.create_map(F.lit("k"), k).alias("attributes")).write.parquet(path)
    S = T.StringType()
    reader = T.StructType([
        N.reader_field("event_id", T.LongType()),
        N.reader_field("person", T.StructType([
            N.reader_field("number", T.LongType(), former=["id"]), N.reader_field("kind", S, former=["type"]),
            N.reader_field("source", S, nullable=False, default="unknown")]), former=["user"]),
        N.reader_field("body", T.StructType([
            N.reader_field("amount", T.DoubleType(), former=["value"]),
            N.reader_field("tags", T.ArrayType(T.StructType([
                N.reader_field("label", S, former=["name"]), N.reader_field("note", S),
                N.reader_field("weights", T.ArrayType(T.IntegerType()), default=[1, 2])])))])),
        N.reader_field("attributes", T.MapType(S, T.DoubleType()))])
    r = N.read_as(spark.read.parquet(path), reader)
    whole = F.forall("body.tags", lambda t: t["note"].isNull() & (t["weights"] == F.array(F.lit(1), F.lit(2))))
    return r.select("event_id", F.col("person.number").alias("who"), F.col("person.kind").alias("kind"), F.col("person.source").alias("source"),
                    F.col("body.amount").alias("amount"), F.transform("body.tags", lambda t: t["label"]).alias("labels"),
                    F.col("attributes")["k"].alias("k"), whole.alias("whole"))
