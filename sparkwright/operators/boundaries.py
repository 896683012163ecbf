"""Range boundaries that are computed once, stored, and deal several tables.

Each task summarises its keys in a quantile sketch of bounded size; the sketches
are merged in a tree (:mod:`sparkwright.functions.state_aggregate`) and give the
cut points.  They are kept in a partition file.  Every table that is dealt by
one file has the same keys in the same partition, so sorted tables merge and join
partition by partition, and the partitions in their order are a total order.

Keys are numbers, dates, times or strings; a null key belongs to partition 0,
before all others.  Equal keys stay together, so a partition holds a key's rows
whole, however many there are: choose a key without hot values.
"""

from __future__ import annotations

from typing import Any, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.state_aggregate import StateAggregate, aggregate_states

#: Keys that a level of the sketch holds for each partition asked for.
KEYS_PER_PARTITION = 128
#: Rows of the larger table that one task of a join takes.
PIECE_ROWS = 1 << 21


class QuantileSketch(StateAggregate):
    """Cut points into ``partitions`` of equal size, from levels of kept keys.

    Level h holds keys that stand for 2^h rows each.  A level that is full is
    sorted, and every second key moves up; which half stays changes each time, so
    errors cancel.  With ``size`` keys a level the rank of a cut is off by about
    levels / (2 size) of the rows at most.
    """

    def __init__(self, partitions: int, key_type: str, size: int | None = None):
        self.partitions, self.result = partitions, f"array<{key_type}>"
        self.size = size or max(1024, KEYS_PER_PARTITION * partitions)

    def init(self):
        return {"levels": [], "halves": 0}

    def iterate(self, state, values):
        values = values.drop_null()
        keys = values.to_numpy(zero_copy_only=False) if _plain(values.type) else np.array(values.to_pylist() + [None], dtype=object)[:-1]
        for at in range(0, len(keys), self.size):
            state = self._compact(self._add(state, 0, keys[at:at + self.size]))
        return state

    def merge(self, a, b):
        for level, keys in enumerate(b["levels"]):
            a = self._add(a, level, keys)
        a["halves"] += b["halves"]
        return self._compact(a)

    def _add(self, state, level, keys):
        while len(state["levels"]) <= level:
            state["levels"].append(keys[:0])
        state["levels"][level] = np.concatenate([state["levels"][level], keys])
        return state

    def _compact(self, state):
        level = 0
        while level < len(state["levels"]):
            keys = state["levels"][level]
            if len(keys) > self.size:
                keys = np.sort(keys)
                odd = len(keys) % 2                      # an odd key out stays below
                state["levels"][level] = keys[:odd]
                state = self._add(state, level + 1, keys[odd + state["halves"] % 2::2])
                state["halves"] += 1
            level += 1
        return state

    def terminate(self, state):
        keys = [k for level in state["levels"] for k in level.tolist()]
        weight = [1 << h for h, level in enumerate(state["levels"]) for _ in range(len(level))]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        total, seen, cuts = sum(weight), 0, []
        for i in order:
            seen += weight[i]
            while len(cuts) < self.partitions - 1 and seen * self.partitions >= total * (len(cuts) + 1):
                cuts.append(keys[i])
        return sorted(set(cuts))


def _plain(kind: pa.DataType) -> bool:
    return pa.types.is_integer(kind) or pa.types.is_floating(kind)


def range_cuts(df: DataFrame, key: str, partitions: int) -> list[Any]:
    """At most ``partitions - 1`` ascending cut points; partition i holds the keys up to cut i."""
    kind = df.schema[key].dataType.simpleString()
    found = aggregate_states(df, [], key, QuantileSketch(partitions, kind), "cuts").collect()
    return list(found[0].cuts or []) if found else []


def store_cuts(spark: SparkSession, cuts: Sequence[Any], key_type: str, path: str) -> None:
    """The partition file: (partition, its largest key); the last partition has no bound and no row."""
    spark.createDataFrame(list(enumerate(cuts)), f"part int, upper {key_type}").coalesce(1).write.parquet(path)


def stored_cuts(spark: SparkSession, path: str) -> list[Any]:
    return [r.upper for r in spark.read.parquet(path).orderBy("part").collect()]


def partition_number(key: Column | str, cuts: Sequence[Any]) -> Column:
    """The partition of a key: a binary search over the cut points, as one expression."""
    key = F.col(key) if isinstance(key, str) else key

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key > F.lit(cuts[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(cuts))


def deal(df: DataFrame, key: str, cuts: Sequence[Any], part: str = "part") -> DataFrame:
    """The rows in the partitions that the cuts give, in the order of partition and key; ``part`` is the partition.

    A partition of many rows is the work of several tasks, each with a range of its keys.
    """
    return df.withColumn(part, partition_number(key, cuts)).repartitionByRange(part, key).sortWithinPartitions(part, key)


def write_dealt(df: DataFrame, key: str, cuts: Sequence[Any], path: str) -> DataFrame:
    """A sorted table with one folder (``part=i``) a partition; its files are sorted and hold ranges of its keys."""
    deal(df, key, cuts).write.partitionBy("part").parquet(path)
    return df.sparkSession.read.parquet(path)


def merge_sorted(tables: Sequence[DataFrame], key: str, cuts: Sequence[Any]) -> DataFrame:
    """Tables of one schema dealt by the same cuts, merged partition by partition into a total order."""
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    return both.repartitionByRange("part", key).sortWithinPartitions("part", key)


def finer(tables: Sequence[DataFrame], key: str, cuts: Sequence[Any]) -> list[Any]:
    """The cuts and more between them, so that a piece has about ``PIECE_ROWS`` rows of the largest table at most."""
    rows = [t.count() for t in tables]                       # of written tables: from the files' footers
    pieces = -(-max(rows) // PIECE_ROWS)
    if pieces <= len(cuts) + 1:
        return list(cuts)
    return sorted({*cuts, *range_cuts(tables[rows.index(max(rows))], key, pieces)})


def merge_join(left: DataFrame, right: DataFrame, key: str, cuts: Sequence[Any], how: str = "inner") -> DataFrame:
    """Join of two tables dealt by the same cuts: partition i meets partition i, nothing is hashed by key.

    Large partitions are cut into pieces, in both tables alike; ``piece`` (before the key) tells an
    aggregate by key that equal keys are already together.
    """
    fine = finer([left, right], key, cuts)
    left, right = (t.withColumn("piece", partition_number(key, fine)).repartitionById(len(fine) + 1, F.col("piece"))
                   for t in (left, right))
    return left.join(right, ["part", "piece", key], how)
