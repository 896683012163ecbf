"""Tables with a layout of their own: keyed loads, lookup files, bucket folders, stored ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boundaries as B
from ..operators import ordering as O
from ..session import scratch_path, table
from ..sinks.keyed import KeyedTable
from ..sinks.numbered_files import BucketFolders, LookupFile
from .registry import query

# --- keyed table: three overlapping loads -------------------------------------

_LOADED = """
SELECT key, user_id, value FROM (
  SELECT lpad(CAST(user_id AS VARCHAR), 10, '0') || ':' || strftime(ts, '%Y%m%d%H') AS key, user_id, value,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y%m%d%H') ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE value < 50 OR event_type <> 'error') WHERE rn = 1"""


def _loaded_cells(spark, sf) -> KeyedTable:
    """Small values in bulk, then clicks directly, a compaction, then all other valid kinds row by row."""
    e = table(spark, sf, "events").select(
        F.concat_ws(":", F.lpad(F.col("user_id").cast("string"), 10, "0"), F.date_format("ts", "yyyyMMddHH")).alias("key"),
        F.struct("ts", "event_id").alias("at"), "user_id", "value", "event_type")
    cells = e.drop("event_type")
    t = KeyedTable.create(spark, scratch_path(spark, "keyed-loads"), cells.schema, "key", "at", B.range_cuts(cells, "key", 4))
    t.load_bulk(cells.where("value < 50"))
    t.load_direct(e.where("event_type = 'click'").drop("event_type"))
    t.compact([0, 2])
    t.load_rows(e.where("event_type not in ('click', 'error')").drop("event_type"))
    return t


@query("keyed_loads", _LOADED, "K20 S23")
def keyed_loads(spark, sf):
    """Bulk, direct and row-wise loads that overlap, merged on read: the newest cell of each key."""
    return _loaded_cells(spark, sf).read().select("key", "user_id", "value")


@query("keyed_loads_compacted", _LOADED, "K20 S23")
def keyed_loads_compacted(spark, sf):
    """The same after a compaction into new regions."""
    t = _loaded_cells(spark, sf)
    t.recut(5)
    return t.read().select("key", "user_id", "value")


@query("keyed_range_read", f"""
SELECT * FROM ({_LOADED}) WHERE key BETWEEN '0000000010' AND '0000000019:~'""", "K20 S23 O11")
def keyed_range_read(spark, sf):
    """A range of keys: the regions outside are not opened."""
    return _loaded_cells(spark, sf).read("0000000010", "0000000019:~").select("key", "user_id", "value")


# --- lookups that open one file ------------------------------------------------

@query("one_file_lookup", """
WITH k AS (SELECT max(s_suppkey) AS present, -1 AS absent FROM supplier)
SELECT l_suppkey, l_orderkey, l_linenumber, 1 AS files FROM lineitem, k WHERE l_suppkey IN (present, absent)""", "J19 K22")
def one_file_lookup(spark, sf):
    """A key that is there and one that is not; the column tells how many files the scans listed a key at most."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    found = LookupFile.write(li, "l_suppkey", scratch_path(spark, "lookup-file"), 16)
    present = table(spark, sf, "supplier").agg(F.max("s_suppkey")).first()[0]
    both = [found.get(k) for k in (present, -1)]
    files = max(len(df.inputFiles()) for df in both)
    return both[0].unionByName(both[1]).withColumn("files", F.lit(files))


@query("key_set_lookup", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""", "J19 K22")
def key_set_lookup(spark, sf):
    """All rows of a set of keys; only the files that can hold them are listed."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    found = LookupFile.write(li, "l_suppkey", scratch_path(spark, "lookup-file"), 32)
    return found.get_all(table(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey")))


# --- bucket samples that read their share ----------------------------------------

@query("bucket_folder_sample", """
SELECT c_custkey, c_name, 1 AS files FROM customer WHERE c_custkey % 8 = 2""", "U05 K16")
def bucket_folder_sample(spark, sf):
    """Bucket 3 of 8 of a table in 8 folders: one folder is read."""
    c = BucketFolders.write(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey",
                            scratch_path(spark, "bucket-folders"), 8)
    sample = c.sample(3, 8)
    return sample.withColumn("files", F.lit(len(sample.inputFiles())))


# --- ranges that are stored and deal two tables -------------------------------------

def _dealt_twice(spark, sf, partitions=6):
    """Line items and orders in the ranges of one partition file, computed from the line items."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_quantity").alias("amount"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("amount"))
    path = scratch_path(spark, "partition-file")
    B.store_cuts(spark, B.range_cuts(li, "orderkey", partitions), "bigint", path)
    cuts = B.stored_cuts(spark, path)
    return [B.write_dealt(df, "orderkey", cuts, scratch_path(spark, name)) for df, name in ((li, "dealt-lines"), (o, "dealt-orders"))], cuts


@query("stored_ranges_order", """
SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM orders) AS rows, 0 AS inversions""", "O06")
def stored_ranges_order(spark, sf):
    """Two sorted tables merged partition by partition: one total order."""
    both, cuts = _dealt_twice(spark, sf)
    return O.order_check(B.merge_sorted(both, "orderkey", cuts), ["orderkey"])


@query("stored_ranges_balance", "SELECT 6 AS partitions, true AS within_target", "O06")
def stored_ranges_balance(spark, sf):
    """Each range of the partition file holds at most 1.2 times the mean of the rows it was made from."""
    (lines, _), cuts = _dealt_twice(spark, sf)
    n = F.col("n")
    return lines.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).cast("int").alias("partitions"), (F.max(n) <= 1.2 * F.sum(n) / (len(cuts) + 1)).alias("within_target"))


@query("stored_ranges_join", """
SELECT o_orderkey AS orderkey, CAST(count(*) AS BIGINT) AS lines, round(sum(l_quantity), 2) AS quantity, max(o_totalprice) AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""", "O06 J01")
def stored_ranges_join(spark, sf):
    """Join of the two tables, range by range."""
    (lines, orders), cuts = _dealt_twice(spark, sf)
    j = B.merge_join(lines, orders.withColumnRenamed("amount", "price"), "orderkey", cuts)
    return j.groupBy("part", "piece", "orderkey").agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("amount"), 2).alias("quantity"),
                                                      F.max("price").alias("price")).drop("part", "piece")
