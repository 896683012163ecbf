"""Joins: equi-joins of every kind, checked broadcasts, lookups.

Spark picks the physical join (broadcast hash when a side is under
``spark.sql.autoBroadcastJoinThreshold`` by statistics, sort-merge
otherwise; AQE re-decides at runtime from real sizes and splits skewed
partitions).  An explicit broadcast is only requested through
:func:`checked_broadcast`, which compares the optimizer's estimate of the
side's bytes with a bound and otherwise leaves the choice to Spark.  No job
runs while a join is being built.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bound in bytes for a side we will ask Spark to broadcast.
BROADCAST_MAX_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (from file sizes and column widths)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is within the bound, else ``df`` unchanged."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join; ``on`` is a column name, list of names, or a Column."""
    return left.join(right, on, how)


def join_by_position(left: DataFrame, lpos: int, right: DataFrame, rpos: int,
                     how: str = "inner") -> DataFrame:
    """JOIN A BY $i, B BY $j: both key columns are kept."""
    lk, rk = left.columns[lpos], right.columns[rpos]
    return left.alias("a").join(right.alias("b"), F.col(f"a.{lk}") == F.col(f"b.{rk}"), how)


def broadcast_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
                   max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Map-side join: the small side is replicated when its bound holds."""
    return big.join(checked_broadcast(small, max_bytes), on, how)


def star_join(fact: DataFrame, dims: Sequence[DataFrame], on,
              max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Chain of joins on one key, each dimension broadcast when small."""
    return reduce(lambda acc, d: acc.join(checked_broadcast(d, max_bytes), on), dims, fact)


def lookup_with_fallback(df: DataFrame, key: str, names: DataFrame, name_key: str,
                         name_col: str, out: str = "name",
                         max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left lookup of a name; a missing or blank name falls back to the id."""
    side = names.select(F.col(name_key).alias("_lk"), F.col(name_col).alias("_ln"))
    j = df.join(checked_broadcast(side, max_bytes), F.col(key) == F.col("_lk"), "left")
    fallback = F.coalesce(F.nullif(F.trim("_ln"), F.lit("")), F.col(key).cast("string"))
    return j.withColumn(out, fallback).drop("_lk", "_ln")


def map_lookup(col, mapping: dict) -> Column:
    """Lookup in a small literal map shared by every task (no join)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[F.col(col) if isinstance(col, str) else col]


def merge_by_key(parts: Iterable[DataFrame], key: str) -> DataFrame:
    """Merge partial records per key by summing every other column.

    The union + grouped sum is one shuffle with map-side combine; a key
    missing from a part contributes zeros, like padded records.  Columns keep
    their kind: fractions stay fractions, whole numbers become longs.
    """
    parts = list(parts)
    kinds: dict[str, str] = {}
    for p in parts:
        for c, t in p.dtypes:
            if c != key:
                whole = t in ("tinyint", "smallint", "int", "bigint")
                kinds[c] = (kinds.get(c, "bigint") if whole else t if kinds.get(c, "bigint") in ("bigint", t) else "double")
    cols = sorted(kinds)
    padded = [p.select(key, *[(F.col(c) if c in p.columns else F.lit(0)).cast(kinds[c]).alias(c)
                              for c in cols]) for p in parts]
    u = reduce(lambda a, b: a.unionByName(b), padded)
    return u.groupBy(key).agg(*[F.sum(c).alias(c) for c in cols])


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """All rows of one key; on a sorted layout the filter prunes row groups."""
    return df.where(F.col(key) == F.lit(value))


def keys_lookup(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All rows whose key is in ``keys`` (left semi join)."""
    return df.join(keys.select(key).distinct(), key, "left_semi")
