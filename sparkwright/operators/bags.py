"""Bag-style grouping: group to bag, cogroup, flatten, per-key collections.

A bag is an ``array<struct>`` column sorted by its fields (so results are
deterministic).  Building a bag holds all rows of one key in one task, so
the bag-producing operators are meant for keys whose groups are bounded by
the data model (lines of an order, orders of a customer).  Whenever a bag
would only feed an aggregate, use a grouped aggregate instead: that runs
partial aggregation and never materialises the group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def group_to_bag(df: DataFrame, key, cols: Sequence[str], bag: str = "bag") -> DataFrame:
    """GROUP df BY key: one row per key with the sorted bag of ``cols``."""
    keys = _cols(key)
    return df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*cols))).alias(bag))


def flatten_bag(df: DataFrame, bag: str) -> DataFrame:
    """FLATTEN(bag): one row per element, crossed with the other columns.

    An empty or null bag yields no row (inner explode).
    """
    others = [c for c in df.columns if c != bag]
    return df.select(*others, F.inline(bag))


def cogroup(a: DataFrame, a_key: str, a_cols: Sequence[str],
            b: DataFrame, b_key: str, b_cols: Sequence[str],
            key: str = "key", inner_a: bool = False, inner_b: bool = False,
            a_bag: str = "a", b_bag: str = "b") -> DataFrame:
    """COGROUP a BY a_key, b BY b_key: (key, bag of a, bag of b).

    Both inputs are tagged and unioned, then grouped once: a single
    shuffle instead of two aggregations and a join.  A key missing on one
    side gets an empty bag; ``inner_a`` / ``inner_b`` drop keys whose bag
    on that side is empty.
    """
    sa = F.struct(*[F.col(c) for c in a_cols])
    sb = F.struct(*[F.col(c) for c in b_cols])
    ta = a.select(F.col(a_key).alias(key), sa.alias("_a"), F.lit(None).cast(sb_type(b, b_cols)).alias("_b"))
    tb = b.select(F.col(b_key).alias(key), F.lit(None).cast(sb_type(a, a_cols)).alias("_a"), sb.alias("_b"))
    # Null keys of the two sides are different keys: such a key carries its side.
    side = F.when(F.col(key).isNull(), F.col("_a").isNull()).alias("_side")
    g = ta.unionByName(tb).groupBy(key, side).agg(
        F.sort_array(F.collect_list("_a")).alias(a_bag),
        F.sort_array(F.collect_list("_b")).alias(b_bag)).drop("_side")
    if inner_a:
        g = g.where(F.size(a_bag) > 0)
    if inner_b:
        g = g.where(F.size(b_bag) > 0)
    return g


def sb_type(df: DataFrame, cols: Sequence[str]) -> str:
    """DDL type of ``struct(cols)`` over ``df`` (for typed null literals)."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return "struct<" + ",".join(f"{c}:{fields[c]}" for c in cols) + ">"


def project_bag(bag: str, field: str) -> Column:
    """bag.field: the bag of one field of every tuple."""
    return F.transform(F.col(bag), lambda x: x[field])


def concat_values(df: DataFrame, key, value: str, sep: str = ";", out: str = "values") -> DataFrame:
    """Per key, the values in sorted order joined with ``sep``."""
    return df.groupBy(*_cols(key)).agg(
        F.array_join(F.sort_array(F.collect_list(F.col(value).cast("string"))), sep).alias(out))


def collect_values(df: DataFrame, key, value: str, out: str = "values") -> DataFrame:
    """Per key, the sorted list of values (duplicates kept)."""
    return df.groupBy(*_cols(key)).agg(F.sort_array(F.collect_list(value)).alias(out))


def unique_values(df: DataFrame, key, value: str, out: str = "values") -> DataFrame:
    """Per key, the sorted set of values (partial sets merge map-side)."""
    return df.groupBy(*_cols(key)).agg(F.array_sort(F.collect_set(value)).alias(out))


def ungroup(df: DataFrame, values: str, out: str = "value") -> DataFrame:
    """Inverse of :func:`collect_values`: one row per element."""
    others = [c for c in df.columns if c != values]
    return df.select(*others, F.explode(values).alias(out))


def count_values(df: DataFrame, key, out: str = "n") -> DataFrame:
    """Values per key counted (no bag is built)."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias(out))


def render_bag(bag, fields: Sequence[str]) -> Column:
    """Bag of structs as text, using the named fields in order."""
    b = F.col(bag) if isinstance(bag, str) else bag

    def tup(x):
        return F.concat(F.lit("("), F.concat_ws(",", *[x[f].cast("string") for f in fields]),
                        F.lit(")"))

    return F.concat(F.lit("{"), F.array_join(F.transform(b, tup), ","), F.lit("}"))
