"""Exact distinct sets that merge: bitmaps of whole-number ids by key and day.

The log is read once.  For each key, day and range of 32,768 ids there is one
bitmap (4 KB, mostly zeros when stored); sets of any period, and of several keys,
are unions of bitmaps, so counts for further periods never read the log again.
Building and merging are aggregates that combine before the shuffle.
"""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_sets(log: DataFrame, keys: Sequence[str], day: Column, id: str) -> DataFrame:
    """``(*keys, day, bucket, bits)``: the ids of each key and day; rows with a null id are left out."""
    number = F.col(id).cast("long")
    return (log.where(number.isNotNull())
            .groupBy(*keys, day.cast("date").alias("day"), F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")))


def add_days(sets: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two stores merged: a day that is in both has the union (a late part of the log may be added twice)."""
    return sets.unionByName(more).groupBy(*keys, "day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def union_sets(sets: DataFrame, keys: Sequence[str], first: Any = None, last: Any = None) -> DataFrame:
    """``(*keys, bucket, bits)``: the union over the days in [first, last]."""
    if first is not None:
        sets = sets.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        sets = sets.where(F.col("day") <= F.lit(last).cast("date"))
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(sets: DataFrame, keys: Sequence[str], first: Any = None, last: Any = None, name: str = "n") -> DataFrame:
    """Distinct ids of each key over the days in [first, last]; keys need not be all that the sets are kept by."""
    merged = union_sets(sets, keys, first, last)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))


def returning_counts(sets: DataFrame, keys: Sequence[str], earlier: tuple, later: tuple, name: str = "n") -> DataFrame:
    """Ids of each key that are in both of two periods: the sizes of the two sets less that of their union."""
    both = [union_sets(sets, keys, *period) for period in (earlier, later)]
    size = F.bitmap_count("bits")
    parts = [b.select(*keys, size.alias("_n")) for b in both]
    union = both[0].unionByName(both[1]).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    parts.append(union.select(*keys, (-size).alias("_n")))
    return (parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(*keys)
            .agg(F.sum("_n").cast("long").alias(name)).where(F.col(name) > 0))
