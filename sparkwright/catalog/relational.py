"""Joins, bags and cogroups over orders / lineitem / customer / supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bags as B
from ..operators import chunked_bags as C
from ..operators import joins as J
from ..sinks.tables import sorted_lookup_file
from ..session import scratch_path, table
from .registry import query


def _bag_sql(expr: str, order: str) -> str:
    return f"string_agg('(' || {expr} || ')', ',' ORDER BY {order})"


# --- equi-joins (orders x lineitem: 257 orders at sf0.01 have no lines) ---

@query("join_inner", """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_quantity
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""", "J02")
def join_inner(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return J.join(o, li, o.o_orderkey == li.l_orderkey).drop("l_orderkey")


@query("join_left", """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_quantity
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""", "J03")
def join_left(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return J.join(o, li, o.o_orderkey == li.l_orderkey, "left").drop("l_orderkey")


@query("join_right", """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderkey, o.o_orderpriority
FROM lineitem l RIGHT JOIN orders o ON l.l_orderkey = o.o_orderkey""", "J04")
def join_right(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return J.join(li, o, li.l_orderkey == o.o_orderkey, "right")


@query("join_full", """
SELECT o.o_orderkey, o.o_orderstatus, l.l_orderkey, l.l_linenumber, l.l_linestatus
FROM orders o FULL JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = l.l_linestatus""", "J05")
def join_full(spark, sf):
    """All orders against all lines of their status: unmatched rows on both sides."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return J.join(o, li, (o.o_orderkey == li.l_orderkey) & (o.o_orderstatus == li.l_linestatus), "full")


@query("join_semi", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""", "J06")
def join_semi(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return J.join(o, li, o.o_orderkey == li.l_orderkey, "left_semi")


@query("join_positional", """
SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_nationkey, n.n_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""", "J08")
def join_positional(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = J.join_by_position(s, 2, n, 0)
    return j.select(F.col("a.s_suppkey"), F.col("a.s_name"), F.col("a.s_nationkey"),
                    F.col("b.n_nationkey"), F.col("b.n_name"))


@query("composite_group_named", """
WITH m AS (SELECT l_suppkey, l_linenumber, max(l_extendedprice) AS max_temperature
           FROM lineitem WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50
           GROUP BY 1, 2)
SELECT m.l_suppkey AS usaf, m.l_linenumber AS wban, trim(s.s_name) AS station_name,
       m.max_temperature
FROM m JOIN supplier s ON m.l_suppkey = s.s_suppkey""", "A10 F02")
def composite_group_named(spark, sf):
    """Max per composite key (usaf, wban) joined to the station name."""
    li = table(spark, sf, "lineitem")
    valid = li.where(F.col("l_linenumber").isin(0, 1, 4, 5, 9) & (F.col("l_quantity") != 50))
    m = (valid.groupBy(F.col("l_suppkey").alias("usaf"), F.col("l_linenumber").alias("wban"))
         .agg(F.max("l_extendedprice").alias("max_temperature")))
    names = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("usaf"), F.trim("s_name").alias("station_name"))
    return m.join(names, "usaf").select("usaf", "wban", "station_name", "max_temperature")


@query("broadcast_join", """
SELECT l.l_orderkey, l.l_linenumber, s.s_name, n.n_name
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""", "J07 J10")
def broadcast_join(spark, sf):
    """Map-side joins: each dimension is broadcast if its estimated bytes are within the bound."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = J.broadcast_join(li, s, li.l_suppkey == s.s_suppkey)
    j = J.broadcast_join(j, n, j.s_nationkey == n.n_nationkey)
    return j.select("l_orderkey", "l_linenumber", "s_name", "n_name")


@query("lookup_fallback", """
WITH m AS (SELECT l_suppkey, max(l_extendedprice) AS max_temperature FROM lineitem
           WHERE l_linenumber IN (0, 1, 4, 5, 9) AND l_quantity <> 50 GROUP BY 1)
SELECT m.l_suppkey AS station_id,
       coalesce(nullif(trim(s.s_name), ''), CAST(m.l_suppkey AS VARCHAR)) AS name,
       m.max_temperature
FROM m LEFT JOIN supplier s ON m.l_suppkey = s.s_suppkey""", "J16")
def lookup_fallback(spark, sf):
    li = table(spark, sf, "lineitem")
    valid = li.where(F.col("l_linenumber").isin(0, 1, 4, 5, 9) & (F.col("l_quantity") != 50))
    m = valid.groupBy(F.col("l_suppkey").alias("station_id")).agg(
        F.max("l_extendedprice").alias("max_temperature"))
    named = J.lookup_with_fallback(m, "station_id", table(spark, sf, "supplier"),
                                   "s_suppkey", "s_name", "name")
    return named.select("station_id", "name", "max_temperature")


# Return-flag codes and their names.
RETURN_FLAG_NAMES = {"A": "accepted", "N": "none", "R": "returned"}


@query("map_lookup", """
SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none'
                         WHEN 'R' THEN 'returned' END AS flag_name,
       count(*) AS n
FROM lineitem GROUP BY 1""", "J17")
def map_lookup(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(J.map_lookup("l_returnflag", RETURN_FLAG_NAMES).alias("flag_name")).agg(
        F.count(F.lit(1)).alias("n"))


@query("reduce_side_join", """
SELECT CAST(l.l_suppkey AS VARCHAR) AS station_id, s.s_name AS station_name,
       l.l_shipdate AS observed_at, l.l_extendedprice AS temperature
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey""", "J01")
def reduce_side_join(spark, sf):
    """Records joined with station names on the station id."""
    recs = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.col("l_shipdate").alias("observed_at"), F.col("l_extendedprice").alias("temperature"))
    st = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("station_id"), F.col("s_name").alias("station_name"))
    return recs.join(st, "station_id", "inner")


@query("key_lookup", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""", "J19 K22")
def key_lookup(spark, sf):
    """Write a key-hashed sorted lookup file, then fetch all rows of a key set."""
    path = scratch_path(spark, "lookup")
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber",
                                             "l_extendedprice")
    sorted_lookup_file(li, "l_suppkey", path)
    keys = table(spark, sf, "supplier").where(F.col("s_acctbal") < 0).select(
        F.col("s_suppkey").alias("l_suppkey"))
    return J.keys_lookup(spark.read.parquet(path), keys, "l_suppkey")


@query("composite_join", """
WITH m AS (SELECT l_suppkey, l_linenumber, max(l_extendedprice) AS max_temperature FROM lineitem GROUP BY 1, 2),
     s AS (SELECT s_suppkey, n, s_name || '-' || CAST(n AS VARCHAR) AS station_name
           FROM supplier, (SELECT unnest(range(1, 4)) AS n))
SELECT l_suppkey AS usaf, l_linenumber AS wban, station_name, max_temperature
FROM m JOIN s ON l_suppkey = s_suppkey AND l_linenumber = n""", "J09")
def composite_join(spark, sf):
    """Joined on both parts of the key (usaf, wban); only three wbans have a name."""
    m = (table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("usaf"), F.col("l_linenumber").alias("wban"))
         .agg(F.max("l_extendedprice").alias("max_temperature")))
    names = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("usaf"), "s_name", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("wban")).select(
        "usaf", "wban", F.concat_ws("-", "s_name", F.col("wban").cast("string")).alias("station_name"))
    return J.join(m, names, ["usaf", "wban"]).select("usaf", "wban", "station_name", "max_temperature")


@query("join_same_names", """
SELECT a.o_orderkey AS a_key, a.o_orderdate AS a_date, b.o_orderkey AS b_key, b.o_orderdate AS b_date
FROM orders a JOIN orders b ON a.o_orderkey + 1 = b.o_orderkey""", "P05")
def join_same_names(spark, sf):
    """Both inputs have the same column names; each is named by its relation: every order with the next one by key."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    a, b = o.alias("a"), o.alias("b")
    j = a.join(b, F.col("a.o_orderkey") + 1 == F.col("b.o_orderkey"))
    return j.select(F.col("a.o_orderkey").alias("a_key"), F.col("a.o_orderdate").alias("a_date"),
                    F.col("b.o_orderkey").alias("b_key"), F.col("b.o_orderdate").alias("b_date"))


@query("point_lookup", """
SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem
WHERE l_suppkey = (SELECT min(s_suppkey) FROM supplier)""", "J19")
def point_lookup(spark, sf):
    """All rows of one key from the sorted lookup file (the filter reaches its row groups)."""
    path = scratch_path(spark, "lookup")
    sorted_lookup_file(table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), "l_suppkey", path)
    key = table(spark, sf, "supplier").agg(F.min("s_suppkey")).first()[0]
    return J.point_lookup(spark.read.parquet(path), "l_suppkey", key)


@query("merge_fractions", """
WITH a AS (SELECT o_custkey AS k, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM orders GROUP BY 1),
     b AS (SELECT c_custkey AS k, sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS total FROM customer GROUP BY 1)
SELECT coalesce(a.k, b.k) AS custkey, CAST(coalesce(a.total, 0) + coalesce(b.total, 0) AS DOUBLE) AS total
FROM a FULL JOIN b ON a.k = b.k""", "J18")
def merge_fractions(spark, sf):
    """Partial sums with cents are merged without losing them."""
    def part(name, key, value):
        return table(spark, sf, name).groupBy(F.col(key).alias("custkey")).agg(
            F.sum(F.col(value).cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
    merged = J.merge_by_key([part("orders", "o_custkey", "o_totalprice"), part("customer", "c_custkey", "c_acctbal")], "custkey")
    return merged.select("custkey", F.col("total").cast("double").alias("total"))


@query("merge_totals", """
WITH a AS (SELECT o_custkey AS k, count(*) AS orders FROM orders GROUP BY 1),
     b AS (SELECT o.o_custkey AS k, count(*) AS lines FROM lineitem l
           JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1)
SELECT coalesce(a.k, b.k) AS custkey, coalesce(a.orders, 0) AS orders,
       coalesce(b.lines, 0) AS lines
FROM a FULL JOIN b ON a.k = b.k""", "J18")
def merge_totals(spark, sf):
    """Two aggregates by the same key merged by summing padded records."""
    o = table(spark, sf, "orders")
    a = o.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("orders"))
    li = table(spark, sf, "lineitem").select("l_orderkey")
    b = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
         .groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("lines")))
    return J.merge_by_key([a, b], "custkey").select("custkey", "orders", "lines")


# --- bags ---------------------------------------------------------------

@query("bag_group", f"""
SELECT l_orderkey, '{{' || {_bag_sql("CAST(l_linenumber AS VARCHAR) || ',' || CAST(l_partkey AS VARCHAR)",
                                     "l_linenumber, l_partkey")} || '}}' AS bag
FROM lineitem GROUP BY l_orderkey""", "A04 A19")
def bag_group(spark, sf):
    """GROUP lineitem BY order: the bag of (line number, part) per order."""
    g = B.group_to_bag(table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey"])
    return g.select("l_orderkey", B.render_bag("bag", ["l_linenumber", "l_partkey"]).alias("bag"))


@query("bag_flatten", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem""", "P24 P25 A21")
def bag_flatten(spark, sf):
    """Group to bags, then FLATTEN them back to rows (round trip)."""
    g = B.group_to_bag(table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey"])
    return B.flatten_bag(g, "bag")


@query("bag_field_max", """
SELECT l_orderkey, max(l_extendedprice) AS max_price, count(*) AS n_lines
FROM lineitem GROUP BY 1""", "A05 A22")
def bag_field_max(spark, sf):
    """MAX(bag.field) and COUNT(bag), folded into one grouped aggregate."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("max_price"),
                                        F.count(F.lit(1)).alias("n_lines"))


@query("concat_agg", """
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ';' ORDER BY CAST(l_partkey AS VARCHAR))
  AS parts
FROM lineitem GROUP BY 1""", "A18")
def concat_agg(spark, sf):
    return B.concat_values(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey", ";", "parts")


@query("unique_values", """
SELECT c_mktsegment, string_agg(DISTINCT CAST(c_nationkey AS VARCHAR), ','
  ORDER BY CAST(c_nationkey AS VARCHAR)) AS nations
FROM customer GROUP BY 1""", "A20")
def unique_values(spark, sf):
    """Per segment, the set of nations (bounded domain; partial sets merge)."""
    u = B.unique_values(table(spark, sf, "customer").withColumn(
        "n", F.col("c_nationkey").cast("string")), "c_mktsegment", "n", "nations")
    return u.select("c_mktsegment", F.array_join("nations", ",").alias("nations"))


@query("collect_ungroup", """
SELECT o_custkey, o_orderkey FROM orders""", "A19 A21")
def collect_ungroup(spark, sf):
    c = B.collect_values(table(spark, sf, "orders"), "o_custkey", "o_orderkey", "orders")
    return B.ungroup(c, "orders", "o_orderkey")


def _cogroup(spark, sf, inner_a=False, inner_b=False):
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    return B.cogroup(c, "c_custkey", ["c_name"], o, "o_custkey", ["o_orderkey"], key="custkey",
                     inner_a=inner_a, inner_b=inner_b, a_bag="customers", b_bag="orders")


_CG_SQL = f"""
WITH ka AS (SELECT c_custkey AS k, {_bag_sql("c_name", "c_name")} AS a FROM customer GROUP BY 1),
     kb AS (SELECT o_custkey AS k, {_bag_sql("CAST(o_orderkey AS VARCHAR)", "o_orderkey")} AS b
            FROM orders GROUP BY 1)
SELECT coalesce(ka.k, kb.k) AS custkey, '{{' || coalesce(ka.a, '') || '}}' AS customers,
       '{{' || coalesce(kb.b, '') || '}}' AS orders
FROM ka {{join}} kb ON ka.k = kb.k"""


@query("cogroup_outer", _CG_SQL.replace("{join}", "FULL JOIN"), "J12")
def cogroup_outer(spark, sf):
    g = _cogroup(spark, sf)
    return g.select("custkey", B.render_bag("customers", ["c_name"]).alias("customers"),
                    B.render_bag("orders", ["o_orderkey"]).alias("orders"))


@query("cogroup_inner", _CG_SQL.replace("{join}", "JOIN"), "J13")
def cogroup_inner(spark, sf):
    """Both sides INNER: keys with a customer and at least one order."""
    g = _cogroup(spark, sf, inner_a=True, inner_b=True)
    return g.select("custkey", B.render_bag("customers", ["c_name"]).alias("customers"),
                    B.render_bag("orders", ["o_orderkey"]).alias("orders"))


@query("cogroup_flatten_one", f"""
WITH kb AS (SELECT o_custkey AS k, {_bag_sql("CAST(o_orderkey AS VARCHAR)", "o_orderkey")} AS b
            FROM orders GROUP BY 1)
SELECT c.c_custkey AS custkey, c.c_name, '{{' || coalesce(kb.b, '') || '}}' AS orders
FROM customer c LEFT JOIN kb ON c.c_custkey = kb.k""", "J14")
def cogroup_flatten_one(spark, sf):
    """FLATTEN the customer bag, keep the orders bag projected to its key."""
    g = _cogroup(spark, sf)
    flat = g.select("custkey", F.inline("customers"),
                    B.project_bag("orders", "o_orderkey").alias("order_keys"))
    return flat.select("custkey", "c_name",
                       F.concat(F.lit("{"), F.array_join(F.transform(
                           "order_keys", lambda k: F.concat(F.lit("("), k.cast("string"),
                                                            F.lit(")"))), ","),
                           F.lit("}")).alias("orders"))


@query("cogroup_flatten_both", """
SELECT c.c_custkey AS custkey, c.c_name, o.o_orderkey
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""", "J15")
def cogroup_flatten_both(spark, sf):
    """Flattening both bags is an inner join; planned as one directly."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return c.join(o, "custkey")


@query("cogroup_null_keys", """
SELECT 'customers' AS side, count(*) AS rows FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'both', 0""", "J12 J13")
def cogroup_null_keys(spark, sf):
    """Null keys of the two sides are different groups: rows of each side's
    null group, and the rows of groups that hold null keys of both."""
    c = table(spark, sf, "customer").select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("k"), "c_custkey")
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"), "o_orderkey")
    g = B.cogroup(c, "k", ["c_custkey"], o, "k", ["o_orderkey"], a_bag="customers", b_bag="orders").where("key is null")
    sizes = g.select(F.size("customers").alias("n"), F.size("orders").alias("m"))
    total = sizes.agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum(F.when((F.col("n") > 0) & (F.col("m") > 0), F.col("n") + F.col("m")).otherwise(0)).alias("b"))
    return total.select(F.expr("stack(3, 'customers', n, 'orders', m, 'both', b) as (side, rows)"))


# --- bags of any size: chunks ----------------------------------------------------

@query("bag_chunks", """
SELECT l_returnflag, (rn - 1) // 5000 AS chunk, CAST((rn - 1) % 5000 AS INT) AS pos, l_orderkey, l_linenumber
FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem)""", "A04 P24")
def bag_chunks(spark, sf):
    """Three keys that hold all rows between them: bags in chunks of 5,000, flattened with their places."""
    bags = C.group_to_chunks(table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey", "l_linenumber"], 5000)
    return bags.select("l_returnflag", "chunk", F.posexplode("bag").alias("pos", "r")).select("l_returnflag", "chunk", "pos", "r.*")


@query("bag_chunk_sizes", """
SELECT l_returnflag, count(*) AS n, true AS full FROM lineitem GROUP BY 1""", "A04 A22")
def bag_chunk_sizes(spark, sf):
    """No array is over the bound; all chunks of a key but the last are full."""
    bags = C.group_to_chunks(table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey"], 1000)
    size = F.size("bag")
    return bags.groupBy("l_returnflag").agg(F.sum(size).cast("long").alias("n"), (
        (F.max(size) <= 1000) & (F.count_if(size < 1000) <= 1) & (F.max("chunk") + 1 == F.count(F.lit(1)))).alias("full"))


@query("collect_chunks", """
SELECT o_orderstatus, (rn - 1) // 2000 AS chunk, string_agg(CAST(o_custkey AS VARCHAR), ';' ORDER BY rn) AS customers
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey) AS rn FROM orders) GROUP BY 1, 2""", "A18 A19")
def collect_chunks(spark, sf):
    v = C.collect_chunks(table(spark, sf, "orders"), "o_orderstatus", "o_custkey", 2000, "customers")
    return v.withColumn("customers", F.array_join(F.transform("customers", lambda x: x.cast("string")), ";"))


_COGROUP_CHUNKS = """
WITH a AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer WHERE c_nationkey <> 3),
b AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS i FROM supplier WHERE s_nationkey <> 5),
ac AS (SELECT c_nationkey AS nation, i // 5 AS chunk, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY i) AS customers FROM a GROUP BY 1, 2),
bc AS (SELECT s_nationkey AS nation, i // 5 AS chunk, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY i) AS suppliers FROM b GROUP BY 1, 2)
SELECT nation, chunk, coalesce(customers, '') AS customers, coalesce(suppliers, '') AS suppliers
FROM ac FULL JOIN bc USING (nation, chunk)"""


def _cogroup_chunks(spark, sf, **inner):
    c = table(spark, sf, "customer").where("c_nationkey <> 3")
    s = table(spark, sf, "supplier").where("s_nationkey <> 5")
    g = C.cogroup_chunks(c, "c_nationkey", ["c_custkey"], s, "s_nationkey", ["s_suppkey"], "nation", bound=5, **inner)

    def text(bag, field):
        return F.array_join(F.transform(bag, lambda x: x[field].cast("string")), ",")
    return g.select("nation", "chunk", text("a", "c_custkey").alias("customers"), text("b", "s_suppkey").alias("suppliers"))


@query("cogroup_chunks_outer", _COGROUP_CHUNKS, "J12")
def cogroup_chunks_outer(spark, sf):
    """Customers and suppliers by nation, five at a time side by side; a nation may lack either."""
    return _cogroup_chunks(spark, sf)


@query("cogroup_chunks_inner", _COGROUP_CHUNKS + """
WHERE nation IN (SELECT c_nationkey FROM a) AND nation IN (SELECT s_nationkey FROM b)""", "J13")
def cogroup_chunks_inner(spark, sf):
    return _cogroup_chunks(spark, sf, inner_a=True, inner_b=True)


@query("cogroup_chunks_flatten_one", """
WITH b AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer),
bc AS (SELECT c_nationkey AS nation, i // 50 AS chunk, CAST(count(*) AS INT) AS n, sum(c_custkey) AS keys FROM b GROUP BY 1, 2)
SELECT nation, s_suppkey, chunk, n, keys FROM supplier JOIN bc ON s_nationkey = nation""", "J14")
def cogroup_chunks_flatten_one(spark, sf):
    """Each supplier with the bag of its nation's customers, in chunks of 50."""
    f = C.flatten_one(table(spark, sf, "supplier"), "s_nationkey", ["s_suppkey"],
                      table(spark, sf, "customer"), "c_nationkey", ["c_custkey"], "nation", 50, "customers")
    total = F.aggregate(F.transform("customers", lambda x: x["c_custkey"]), F.lit(0).cast("long"), lambda s, x: s + x)
    return f.select("nation", "s_suppkey", "chunk", F.size("customers").alias("n"), total.alias("keys"))
