"""Unions and sampling."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of same-typed relations, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_positional(frames: Sequence[DataFrame], prefix: str = "f") -> DataFrame:
    """UNION of relations of different width: the schema is dropped.

    Every relation is renamed positionally (f0, f1, ...) and widened to
    strings; a shorter row has nulls in the missing positions.
    """
    width = max(len(f.columns) for f in frames)
    norm = [f.select(*[F.col(c).cast("string").alias(f"{prefix}{i}")
                       for i, c in enumerate(f.columns)]) for f in frames]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), norm)
    return out.select(*[f"{prefix}{i}" for i in range(width)])


def bucket_sample(df: DataFrame, col: str, bucket: int, of: int) -> DataFrame:
    """TABLESAMPLE(BUCKET x OUT OF y ON col): rows whose bucket is x-1.

    Integral columns bucket by value mod y; other types by their hash.
    """
    if not 1 <= bucket <= of:
        raise ValueError("bucket must be in 1..of")
    dtype = dict(df.dtypes)[col]
    v = F.col(col) if dtype in ("int", "bigint", "smallint", "tinyint") else F.hash(col)
    return df.where(F.pmod(v, F.lit(of)) == bucket - 1)


def random_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample, each row kept with probability ``fraction``."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
