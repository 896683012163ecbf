"""Bags of any size: (key, chunk, array of at most ``bound`` rows).

A bag that is one array must fit one task.  Here the rows of all keys are sorted
over range partitions by key, row and place, so a key with many rows lies in as
many partitions as its size needs; the row's number in its key is its place in the
partition plus the sum of the key's counts in the partitions before.  Rows are then
grouped by key and chunk (number div bound): no array is longer than the bound
and no task holds a key.  Chunks of a key are numbered from 0 in the order of the
rows, and all but the last are full.

Rows that are equal stay apart by their place; nulls sort first.  Columns of a bag
must be sortable (no maps).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

BOUND = 10_000


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    """Null-safe equality of the columns of two aliased frames."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def numbered_rows(df: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``(*key, number, row)``: the rows of each key in their order, numbered from 0."""
    spark, keys = df.sparkSession, _names(key)
    rows = df.select(*keys, F.struct(*cols).alias("_row"), F.monotonically_increasing_id().alias("_tie"))
    order = [*keys, "_row", "_tie"]
    path = scratch_path(spark, "sorted-bags")
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .select(*keys, "_row", F.monotonically_increasing_id().alias("_place")).write.parquet(path))
    # the upper bits of a place are the range partition, the lower ones count its rows
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    per = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(*keys, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = placed.alias("r").join(starts.alias("s"), _same("r", "s", keys) & (F.col("r._part") == F.col("s._part")))
    return joined.select(*[F.col(f"r.{k}").alias(k) for k in keys], (F.col("r._place") + F.col("s._shift")).alias("number"),
                         F.col("r._row").alias("row"))


def group_to_chunks(df: DataFrame, key: str | Sequence[str], cols: Sequence[str], bound: int = BOUND, bag: str = "bag") -> DataFrame:
    """GROUP BY key: one row a key and chunk with at most ``bound`` rows in order."""
    keys = _names(key)
    rows = numbered_rows(df, keys, cols).withColumn("chunk", F.floor(F.col("number") / bound).cast("long"))
    packed = rows.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list(F.struct("number", "row"))).alias("_rows"))
    return packed.select(*keys, "chunk", F.transform("_rows", lambda x: x["row"]).alias(bag))


def collect_chunks(df: DataFrame, key: str | Sequence[str], value: str, bound: int = BOUND, out: str = "values") -> DataFrame:
    """Sorted values of each key in chunks; null values are not collected."""
    bags = group_to_chunks(df.where(F.col(value).isNotNull()), key, [value], bound, "_bag")
    return bags.select(*_names(key), "chunk", F.transform("_bag", lambda x: x[value]).alias(out))


def flatten_chunks(chunks: DataFrame, bag: str) -> DataFrame:
    """One row for each row of a bag, crossed with the other columns but the chunk's number."""
    return chunks.select(*[c for c in chunks.columns if c not in (bag, "chunk")], F.inline(bag))


def cogroup_chunks(a: DataFrame, a_key: str, a_cols: Sequence[str], b: DataFrame, b_key: str, b_cols: Sequence[str],
                   key: str = "key", inner_a: bool = False, inner_b: bool = False, bound: int = BOUND,
                   a_bag: str = "a", b_bag: str = "b") -> DataFrame:
    """COGROUP: (key, chunk, part of a's bag, part of b's bag).

    The bags of a key are cut side by side: chunk i holds chunk i of either side,
    and an empty bag where a side has no more rows.  ``inner_a`` / ``inner_b`` drop
    the keys without any row on that side.  Null keys of the two sides are
    different keys.
    """
    left = group_to_chunks(a.select(F.col(a_key).alias(key), *a_cols), key, a_cols, bound, a_bag)
    right = group_to_chunks(b.select(F.col(b_key).alias(key), *b_cols), key, b_cols, bound, b_bag)
    path_a, path_b = (scratch_path(a.sparkSession, "bag-chunks") for _ in range(2))
    left.write.parquet(path_a)
    right.write.parquet(path_b)
    left, right = (a.sparkSession.read.parquet(p) for p in (path_a, path_b))
    # an inner side's keys are those of its first chunks, one row a key
    keys_a, keys_b = (c.where("chunk = 0").select(key) for c in (left, right))
    if inner_a:
        right = right.join(keys_a, key, "left_semi")
    if inner_b:
        left = left.join(keys_b, key, "left_semi")
    out = left.join(right, [key, "chunk"], "full")
    empty_a, empty_b = (F.array().cast(d.schema[c].dataType) for d, c in ((left, a_bag), (right, b_bag)))
    return out.select(key, "chunk", F.coalesce(a_bag, empty_a).alias(a_bag), F.coalesce(b_bag, empty_b).alias(b_bag))


def flatten_one(a: DataFrame, a_key: str, a_cols: Sequence[str], b: DataFrame, b_key: str, b_cols: Sequence[str],
                key: str = "key", bound: int = BOUND, b_bag: str = "b") -> DataFrame:
    """FLATTEN a's bag, keep b's: each row of a with every chunk of its key's bag of b (keys of both sides)."""
    bags = group_to_chunks(b.select(F.col(b_key).alias(key), *b_cols), key, b_cols, bound, b_bag)
    return a.select(F.col(a_key).alias(key), *a_cols).join(bags, key).select(key, *a_cols, "chunk", b_bag)
