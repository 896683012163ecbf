"""Sorting, top-k, partition assignment and order specs.

A global sort is a range exchange (sampled boundaries) + per-partition
sort.  Every global sort ends in a tie-breaker, the row's place in the
input: rows with equal keys, and even equal rows, can be cut between range
partitions, so a hot key is not sorted by one task, and equal rows keep
their input order.
"""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import quoted


def order_by(df: DataFrame, cols: Sequence[str], ascending: Sequence[bool] | None = None) -> DataFrame:
    """ORDER BY cols with per-column direction (default ascending)."""
    ascending = ascending or [True] * len(cols)
    return _sorted(df, [F.col(c).asc() if a else F.col(c).desc() for c, a in zip(cols, ascending)])


def _sorted(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """A global sort by the keys and the place in the input."""
    return df.withColumn("_place", F.monotonically_increasing_id()).orderBy(*keys, "_place").drop("_place")


def order_check(df: DataFrame, cols: Sequence[str], ascending: Sequence[bool] | None = None,
                across: bool = True) -> DataFrame:
    """(rows, inversions) of a sorted frame in the order its partitions hold it.

    Neighbours inside a partition are compared through a window over the
    place; with ``across`` also the last row of each partition with the first
    of the next one that has rows (one row for each partition).
    """
    ascending = list(ascending or [True] * len(cols))
    place = (df.select(F.struct(*cols).alias("now")).withColumn("part", F.spark_partition_id())
             .withColumn("place", F.monotonically_increasing_id()))
    w = Window.partitionBy("part").orderBy("place")
    inside = place.select("part", "place", "now", F.lag("now").over(w).alias("before"))
    per = inside.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_wrong_way(cols, ascending)).alias("bad"),
        F.min_by("now", "place").alias("now"), F.max_by("now", "place").alias("last"))
    if across:
        per = per.withColumn("before", F.lag("last").over(Window.orderBy("part")))
        per = per.withColumn("bad", F.col("bad") + F.coalesce(_wrong_way(cols, ascending).cast("int"), F.lit(0)))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bad"), F.lit(0)).alias("inversions"))


def _wrong_way(cols: Sequence[str], ascending: Sequence[bool]) -> Column:
    """True where ``before`` sorts after ``now``; nulls are least."""
    wrong, equal = F.lit(False), F.col("before").isNotNull()
    for c, up in zip(cols, ascending):
        a, b = F.col("before")[c], F.col("now")[c]
        low, high = (a, b) if up else (b, a)
        after = (low.isNotNull() & high.isNull()) | F.coalesce(low > high, F.lit(False))
        wrong = wrong | (equal & after)
        equal = equal & a.eqNullSafe(b)
    return wrong


def top_k(df: DataFrame, k: int, cols: Sequence[str], ascending: Sequence[bool] | None = None) -> DataFrame:
    """First ``k`` rows in the given order (planned as TakeOrderedAndProject:
    each task keeps its own top k, the driver merges k x tasks rows)."""
    ascending = list(ascending or [True] * len(cols))
    rest = [c for c in df.columns if c not in cols]
    keys = [F.col(c).asc() if a else F.col(c).desc() for c, a in zip(cols, ascending)]
    return df.orderBy(*keys, *[F.col(c).asc() for c in rest]).limit(k)


def distribute_sort(df: DataFrame, key: Sequence[str], sort: Sequence[str],
                    partitions: int | None = None) -> DataFrame:
    """DISTRIBUTE BY key SORT BY sort: hash partitions, each sorted."""
    keys = [F.col(c) for c in key]
    out = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    return out.sortWithinPartitions(*sort)


def total_sort(df: DataFrame, cols: Sequence[str], ascending: Sequence[bool] | None = None,
               partitions: int | None = None) -> DataFrame:
    """Total order across partitions via sampled range partitioning.

    The remaining columns are appended to the sort key so equal keys can be
    split between range partitions (balanced output under skew).
    """
    ascending = list(ascending or [True] * len(cols))
    rest = [c for c in df.columns if c not in cols]
    keys = [F.col(c).asc() if a else F.col(c).desc() for c, a in zip(cols, ascending)]
    keys += [F.col(c).asc() for c in rest]
    if partitions:
        df = df.withColumn("_place", F.monotonically_increasing_id())
        return df.repartitionByRange(partitions, *keys, "_place").sortWithinPartitions(*keys, "_place").drop("_place")
    return _sorted(df, keys)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition (balance check)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def partition_of(key, n: int) -> Column:
    """Partition index ``repartition(n, key)`` assigns to a row."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.hash(k), F.lit(n))


def first_per_group(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """Top ``n`` rows per group (secondary sort / latest N per key).

    ``row_number() <= n`` lets Spark insert a partial group limit before the
    shuffle (WindowGroupLimit), so each task ships at most ``n`` rows per
    key even when one key is hot.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


# Order spec words for schema-directed sorts.
ASCENDING, DESCENDING, IGNORE = "ascending", "descending", "ignore"


def schema_sort(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Sort by the fields of a record schema, each with an order attribute.

    Fields marked 'ignore' take no part in the order; duplicates are kept.
    Fields are compared in the order the spec lists them.
    """
    keys = []
    for name, order in spec.items():
        if order == IGNORE:
            continue
        if order not in (ASCENDING, DESCENDING):
            raise ValueError(f"bad order {order!r} for field {name}")
        keys.append(F.col(name).asc() if order == ASCENDING else F.col(name).desc())
    return _sorted(df, keys)


_KEY_RE = re.compile(r"^-k(\d+)(?:,(\d+))?([nr]*)$")


def parse_key_spec(spec: str) -> list[tuple[int, bool, bool]]:
    """'-k1n -k2nr' -> [(field index 1-based, numeric, reverse), ...]."""
    out = []
    for tok in spec.split():
        m = _KEY_RE.match(tok)
        if not m:
            raise ValueError(f"bad key spec {tok!r}")
        out.append((int(m.group(1)), "n" in m.group(3), "r" in m.group(3)))
    return out


def field_spec_sort(df: DataFrame, line: str, spec: str, sep: str = "\t") -> DataFrame:
    """Sort text lines by key fields: numeric ('n') and/or reversed ('r')."""
    parts = F.split(F.col(line), quoted(sep))
    keys = []
    for idx, numeric, reverse in parse_key_spec(spec):
        f = F.get(parts, idx - 1)
        k = f.try_cast("double") if numeric else f
        keys.append(k.desc() if reverse else k.asc())
    return _sorted(df, [*keys, F.col(line).asc()])
